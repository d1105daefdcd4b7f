"""Keyed tables: changes between versions, synchronisation, upserts."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import pytest

from tradeloom.session import new_run_folder
from tradeloom.sources import keyed

DDL = "k string, part int, v string"


def table(spark, label, depth=1):
    return keyed.KeyedTable(new_run_folder(spark, label), ("k", "part"), depth)


def frame(spark, given):
    return spark.createDataFrame(given, DDL)


def files(t):
    found = Path(t.root.removeprefix("file:"), "rows").rglob("*.parquet")
    return {str(p): hashlib.md5(p.read_bytes()).hexdigest() for p in found}


def held(spark, t, version=None):
    return Counter(tuple(r) for r in keyed.open_version(spark, t, version).collect())


def told(spark, t, old, new):
    return {(r.k, r.part, r.v): (r.CHANGE, r.BEFORE, r.AFTER) for r in keyed.changes_between(spark, t, old, new).collect()}


def expected(old, new):
    old, new = Counter(old), Counter(new)
    was, now = {r[:2] for r in old}, {r[:2] for r in new}
    kind = lambda key: "inserted" if key not in was else "deleted" if key not in now else "changed"
    return {r: (kind(r[:2]), old[r], new[r]) for r in old.keys() | new.keys() if old[r] != new[r]}


AWKWARD = [("a", 1, "x"), ("a", 1, "x"), ("a", 1, None), (None, 1, "x"), ("", None, ""), (None, None, None), ("b", 2, "é" * 5000)]


def test_changes_of_awkward_rows(spark):
    t = table(spark, "awkward")
    later = [("a", 1, "x"), ("a", 1, None), ("a", 1, None), (None, 1, "y"), ("", None, ""), ("c", 3, "z"), ("a", None, "1")]
    first, _ = keyed.synchronise(frame(spark, AWKWARD), t)
    second, _ = keyed.synchronise(frame(spark, later), t)
    assert told(spark, t, first, second) == expected(AWKWARD, later)
    assert held(spark, t, first) == Counter(AWKWARD) and held(spark, t) == Counter(later)


def test_values_that_trade_places_are_a_change(spark):
    t = keyed.KeyedTable(new_run_folder(spark, "places"), ("k",), 1)
    rows = lambda a, b: spark.createDataFrame([("k", a, b)], "k string, a string, b string")
    keyed.synchronise(rows("x", None), t)
    assert keyed.synchronise(rows(None, "x"), t)[1] != []


def test_empty_tables(spark):
    t = table(spark, "empty")
    with pytest.raises(ValueError):
        keyed.open_version(spark, t)
    first, _ = keyed.synchronise(frame(spark, []), t)
    assert held(spark, t) == Counter()
    second, _ = keyed.upsert(frame(spark, AWKWARD), t)
    third, _ = keyed.synchronise(frame(spark, []), t)
    assert {c[0] for c in told(spark, t, first, second).values()} == {"inserted"}
    assert {c[0] for c in told(spark, t, second, third).values()} == {"deleted"}
    assert keyed.upsert(frame(spark, []), t) == (third, [])


@pytest.mark.parametrize("seed", range(3))
def test_random_versions_equal_full_comparison(spark, seed):
    draw = random.Random(seed)
    rows = lambda n: [(draw.choice("abcdefghij") * draw.randint(1, 3), draw.randint(0, 3), draw.choice("xyz")) for _ in range(n)]
    old, t = rows(300), table(spark, "random", depth=draw.choice([1, 2, 3]))
    new = [r for r in old if draw.random() < 0.9] + rows(5)
    first, _ = keyed.synchronise(frame(spark, old), t)
    second, _ = keyed.synchronise(frame(spark, new), t)
    assert told(spark, t, first, second) == expected(old, new)


def test_only_changed_leaves_are_read_and_written(spark):
    t, given = table(spark, "leaves", depth=2), [(f"k{i}", i % 3, "v") for i in range(2000)]
    first, every = keyed.synchronise(frame(spark, given), t)
    before = files(t)
    assert keyed.synchronise(frame(spark, given[::-1]), t) == (first, []) and files(t) == before
    changed = [*given[:-2], ("k1998", 0, "new"), ("k1999", 1, "v")]
    second, leaves = keyed.synchronise(frame(spark, changed), t)
    assert len(every) > 200 and len(leaves) == 1
    after = files(t)
    assert before.items() <= after.items() and len(after) - len(before) == 1
    read = keyed.open_version(spark, t, first, leaves)
    assert len(read.inputFiles()) == 1 and 0 < read.count() < 40
    assert told(spark, t, first, second) == expected(given, changed)


def test_upsert_replaces_keys_and_leaves_other_files(spark):
    t, given = table(spark, "upsert", depth=2), [(f"k{i}", 0, "old") for i in range(1500)] + [("k7", 0, "again"), (None, 0, "n")]
    keyed.upsert(frame(spark, given), t)
    before = files(t)
    delivery = [("k7", 0, "new"), (None, 0, "m"), ("fresh", 0, "f")]
    version, leaves = keyed.upsert(frame(spark, delivery), t)
    want = Counter([r for r in given if r[0] not in ("k7", None)] + delivery)
    assert held(spark, t) == want and len(leaves) <= 3
    assert before.items() <= files(t).items()
    again, _ = keyed.upsert(frame(spark, delivery), t)
    assert held(spark, t) == want and told(spark, t, version, again) == {}


def test_a_run_cut_off_leaves_the_last_version(spark, monkeypatch):
    t = table(spark, "cut")
    first, _ = keyed.upsert(frame(spark, AWKWARD), t)
    with monkeypatch.context() as cut, pytest.raises(RuntimeError):
        cut.setattr(keyed, "append_rows", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        keyed.upsert(frame(spark, [("a", 1, "other")]), t)
    assert keyed.last_version(spark, t) == first and held(spark, t) == Counter(AWKWARD)
    keyed.upsert(frame(spark, [("a", 1, "other")]), t)
    assert held(spark, t)[("a", 1, "other")] == 1


def test_a_second_writer_is_refused(spark, monkeypatch):
    t = table(spark, "writers")
    keyed.upsert(frame(spark, AWKWARD), t)
    write = keyed._write_rows

    def meanwhile(rows, table, version):
        monkeypatch.setattr(keyed, "_write_rows", write)
        keyed.upsert(frame(spark, [("other", 1, "writer")]), table)
        write(rows, table, version)

    monkeypatch.setattr(keyed, "_write_rows", meanwhile)
    with pytest.raises(RuntimeError):
        keyed.upsert(frame(spark, [("a", 1, "late")]), t)
    assert held(spark, t)[("other", 1, "writer")] == 1


def test_columns_must_fit(spark):
    t = table(spark, "columns")
    keyed.upsert(frame(spark, AWKWARD), t)
    with pytest.raises(ValueError):
        keyed.upsert(frame(spark, AWKWARD).drop("v"), t)
