"""Runs, decontamination and spelling variants against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from cases import AWKWARD, DATA, DOCUMENTS, documents, store
from hypothesis import given, settings
from hypothesis import strategies as st

from tradeloom.llm import variants, winnowing
from tradeloom.llm.runs import Extensions, find_runs, lyndon_lengths, op11_runs, planted, runs_of
from tradeloom.llm.variants import near_in_cell, op13_variants, suffix_order
from tradeloom.llm.winnowing import OP12_SQL, op12_decontamination

ITEMS = "item_id long, text string, kept array<long>, words string, start int, text_a int"


def longest_lyndon(symbols) -> list[int]:
    n = len(symbols)
    return [next(j for j in range(i + 1, n + 1) if j == n or symbols[j:] < symbols[i:]) - i for i in range(n)]


def plain_runs(words: list) -> list[tuple]:
    found = set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            run = words[i : j + q]
            if len(run) >= max(12, 2 * q) and not any(run[r:] == run[:-r] for r in range(1, q)):
                found.add((i, len(run), q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=40))
def test_lyndon_arrays(symbols):
    framed = np.array([0, *symbols, 0])
    assert lyndon_lengths(framed)[1:-1].tolist() == longest_lyndon(symbols)
    turned = [4 - s for s in symbols]
    assert lyndon_lengths(np.array([0, *turned, 0]))[1:-1].tolist() == longest_lyndon(turned)


def test_lyndon_lengths_end_with_each_string():
    assert lyndon_lengths(np.array([0, 1, 2, 0, 1, 1, 3, 0]))[[1, 2, 4, 5, 6]].tolist() == [2, 1, 3, 2, 1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 3), min_size=1, max_size=7), st.integers(1, 40)), max_size=5))
def test_runs_of_repeated_blocks(blocks):
    texts = [(block * 40)[:size] for block, size in blocks] + [[x for block, size in blocks for x in (block * 40)[:size]]]
    words = np.array([w for t in texts for w in t], np.int64)
    found = runs_of(words, np.repeat(np.arange(len(texts)), [len(t) for t in texts]))
    wanted, first = [], 0
    for text in texts:
        wanted += [(i + first, n, q) for i, n, q in plain_runs(text)]
        first += len(text)
    assert list(map(tuple, found.tolist())) == wanted


def test_extensions_of_a_word_that_defeats_hashes_modulo_powers_of_two():
    thue = np.array([bin(i).count("1") % 2 + 1 for i in range(1 << 13)])
    a, b = np.array([0, 0]), np.array([1 << 12, 3 << 11])
    wanted = [next((k for k in range(len(thue) - y) if thue[x + k] != thue[y + k]), len(thue) - y) for x, y in zip(a, b)]
    assert Extensions(thue).reach(a, b, len(thue) - b, True).tolist() == wanted


def run_digests(doc_id, text) -> tuple:
    words = planted((text or "").encode().split(), doc_id)
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    digests = hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], *digests)


def by_text(rows):
    return sorted(map(tuple, rows), key=repr)


def test_run_query_on_awkward_texts(spark, tmp_path):
    draw = random.Random(4)
    texts = [t if t is None or len(t) < 9000 else t[:900] for t in AWKWARD]
    texts += [" ".join(draw.choice("ab") for _ in range(draw.randint(10, 120))) for _ in range(60)]
    texts += ["x y z " * 9, "one two " * 6, "u v " * 5 + "u", "a b a c " * 4 + "q " * 12]
    rows, schema = documents(texts)
    # Ids that repeat, with equal and other texts, and rows without an id.
    rows += [rows[-1], (rows[-1][0], "r s " * 8, *rows[-1][2:]), *[(None, t, *rows[0][2:]) for t in (None, "k " * 13)]]
    found = op11_runs(spark, store(spark, tmp_path, documents=(rows, schema)))
    assert by_text(found.collect()) == by_text(run_digests(r[0], r[1]) for r in rows)


def test_run_query_on_given_texts(spark):
    rows = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [r for r in rows if len(r.text or "") < 6000]
    found = {r.doc_id: tuple(r) for r in op11_runs(spark, f"{DATA}/sf0.001").collect()}
    assert [found[r.doc_id] for r in rows] == [run_digests(*r) for r in rows]


def test_a_very_long_text_of_one_word_and_runs_as_they_are(spark, tmp_path):
    folder = store(spark, tmp_path, documents=documents(["w " * 400_000, "a b " * 7 + "c"]))
    rows = find_runs(spark.read.parquet(f"{folder}/documents.parquet")).orderBy("doc_id").collect()
    assert [(list(map(tuple, r.runs)), r.collapsed) for r in rows] == [([(0, 400_000, 1)], "w"), ([(0, 14, 2)], "a b c")]


def leaked() -> tuple[list, list]:
    """Documents and items that share whole windows, parts of them and short items."""
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abé") for _ in range(2))
    items = [" ".join(word() for _ in range(n)) for n in (40, 25, 10, 11, 30)]
    items += [items[0], items[1].upper(), "", None, "one", "Two, words", " ".join(f"w{i}" for i in range(7)), "a b c d e f g h i", "a " * 30]
    texts = [*AWKWARD]
    for item in [i for i in items if i]:
        words = item.split()
        for size in (9, 10, 12, 40):
            at = draw.randrange(max(1, len(words) - size))
            texts.append(" ".join([word() for _ in range(15)] + words[at : at + size] + [word() for _ in range(15)]))
    texts += [texts[20]] * 30 + ["one", "two;words, two words", "é" * 9, "É é É é É é É é É é", " ".join(f"W{i}" for i in range(9)), "a " * 11, "a " * 9]
    return texts, items


def sql_rows(folder: str) -> list[tuple]:
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        path = f"{folder}/{name}.parquet"
        con.execute(f"create view {name} as select * from '{path}{'/*.parquet' if Path(path).is_dir() else ''}'")
    return con.execute(OP12_SQL).fetchall()


def plain_hits(texts, items) -> list[tuple]:
    upper = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    cut = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(upper))
    windows: dict[tuple, set] = {}
    for item_id, text in items:
        words = cut(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item_id)
    out = []
    for doc_id, text in texts:
        words, hit, found = cut(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if ids := windows.get(tuple(words[i : i + size])):
                    hit |= set(range(i, i + size))
                    found |= {str(x) for x in ids if x is not None}
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return out


def test_decontamination_of_awkward_rows(spark, tmp_path):
    texts, items = leaked()
    rows, schema = documents(texts)
    rows += [(None, texts[20], *rows[0][2:]), (None, None, *rows[0][2:]), (rows[20][0], "another text", *rows[0][2:])]
    bench = [(i, t, [i], "w", i, i) for i, t in enumerate(items)]
    bench += [(None, "no id but ten words in a row to be hit here", None, None, None, None), bench[0], (3, "a second text of item three with ten words or more", None, None, 1, 1)]
    rows.append((999, "x no id but ten words in a row to be hit here x", *rows[0][2:]))
    folder = store(spark, tmp_path, documents=(rows, schema), benchmark=(bench, ITEMS))
    found = by_text(op12_decontamination(spark, folder).collect())
    assert found == by_text(plain_hits([r[:2] for r in rows], [b[:2] for b in bench]))
    assert found == by_text(sql_rows(folder))


def test_decontamination_of_given_texts(spark):
    folder = f"{DATA}/sf0.01"
    found = by_text(op12_decontamination(spark, folder).collect())
    assert found == by_text(sql_rows(folder))
    assert sum(r[-1] for r in found) > 10


@pytest.mark.parametrize("size", range(10, 16))
def test_every_window_leaves_a_shared_fingerprint(spark, size):
    draw = random.Random(size)
    shared = [str(draw.randrange(5)) for _ in range(size)]
    rows = [(i, " ".join([str(draw.randrange(5)) for _ in range(draw.randrange(30))] + shared + [str(draw.randrange(5))] * draw.randrange(9))) for i in range(40)]
    words = spark.createDataFrame(rows, "id int, text string").select("id", winnowing.word_hashes(winnowing.F.col("text")).alias("words"))
    kept = [set(r.kept) for r in winnowing.kept_hashes(words, "words", 10, "kept").collect()]
    assert all(a & b for a in kept for b in kept)


@pytest.mark.parametrize("texts, items", [([], []), ([], ["some words"]), (["some words", None], []), (["some"], [None, ""])])
def test_decontamination_of_empty_tables(spark, tmp_path, texts, items):
    bench = [(i, t, None, None, None, None) for i, t in enumerate(items)]
    found = op12_decontamination(spark, store(spark, tmp_path, documents=documents(texts), benchmark=(bench, ITEMS)))
    assert by_text(found.collect()) == by_text(plain_hits(list(enumerate(texts)), list(enumerate(items))))


def test_decontamination_runs_no_python(spark):
    found = op12_decontamination(spark, f"{DATA}/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    text = Path(winnowing.__file__).read_text()
    assert not re.search(r"udf|pandas|applyIn|mapIn|\.rdd|numpy", text)


def one_apart(a, b) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(rows) -> list[tuple]:
    upper = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    counts: Counter = Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate(upper)):
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    by_gap: dict = {}
    for w in words:
        for i in range(len(w) + 1):
            for key in {(i, w[:i], w[i:]), (i, w[:i], w[i + 1 :])}:
                by_gap.setdefault(key, set()).add(w)
    near = {w: {v for i in range(len(w) + 1) for key in ((i, w[:i], w[i:]), (i, w[:i], w[i + 1 :])) for v in by_gap[key] if one_apart(w, v)} for w in words}
    form = {}
    for w, group in near.items():
        best = min(group, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), form[w] and words[form[w]]))
    return out


def misspelt() -> list[str]:
    draw = random.Random(3)
    texts = []
    for base, times in (("bananaénab", 4000), ("internat", 300), ("aaaaaaaa", 60)):
        for _ in range(40):
            word, left = base, times
            while left >= 2:
                texts.append(f"{word} " * left)
                i = draw.randrange(len(word) + 1)
                word = word[:i] + draw.choice(["", "a", "b", "ÿ"]) + word[i + draw.randrange(2) :]
                left //= draw.choice([10, 12, 3])
    return texts


def test_variant_query_on_awkward_texts(spark, tmp_path):
    texts = [*AWKWARD, *misspelt(), "CafÉcafés CafÉcafés", "z" * 400 + " " + "z" * 400, ("z" * 401 + " ") * 30]
    rows, schema = documents(texts)
    rows += [rows[20], (None, "unnumbered words of unnumbered rows", *rows[0][2:]), (rows[20][0], "anotherr anotherr", *rows[0][2:])]
    found = op13_variants(spark, store(spark, tmp_path, documents=(rows, schema)))
    assert by_text(found.collect()) == by_text(plain_variants(r[:2] for r in rows))


@pytest.mark.parametrize("letters", [None, 300])
def test_variant_query_on_given_texts(spark, monkeypatch, letters):
    if letters:  # many halves are then dealt over grids of cells
        monkeypatch.setattr(variants, "CELL_LETTERS", letters)
    rows = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = by_text(op13_variants(spark, f"{DATA}/sf0.001").collect())
    assert found == by_text(plain_variants(rows))
    assert len({r[2] for r in found}) < len(found)


@pytest.mark.parametrize("query", [op11_runs, op13_variants])
def test_empty_tables(spark, tmp_path, query):
    assert query(spark, store(spark, tmp_path, documents=documents([]))).count() == 0
    rows = [(i, None, None, None, None) for i in (1, 1, None)]
    folder = store(spark, tmp_path / "nulls", documents=(rows, DOCUMENTS))
    assert query(spark, folder).count() == (3 if query is op11_runs else 0)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("abé", min_size=7, max_size=20), min_size=1, max_size=25))
def test_cells_find_all_words_one_edit_away(texts):
    words = sorted(w.encode("latin-1") for w in texts)
    counts = np.arange(len(words)) % 3 + 2
    near = Counter()
    for ending in (False, True):
        for i, n, _ in near_in_cell(words, counts, words, ending):
            near[i] += n
    assert [near[i] for i in range(len(words))] == [sum(one_apart(w, v) for v in words) for w in words]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=30), min_size=1, max_size=8))
def test_suffix_order_reads_to_the_end_of_a_string(texts):
    data = np.array([ord(c) for t in texts for c in t + "\x00"])
    ends = np.cumsum([len(t) + 1 for t in texts])
    whole = bytes(data.tolist())
    rest = [(whole[i : ends[np.searchsorted(ends, i, "right")]], i) for i in range(len(whole))]
    assert suffix_order(data, ends).tolist() == [i for _, i in sorted(rest)]
