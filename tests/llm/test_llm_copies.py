"""Near copies, repeats, components and the pipeline against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from cases import AWKWARD, DATA, documents, store

import corpus_pipeline
from tradeloom.llm import near_copies, repeats
from tradeloom.llm.components import components
from tradeloom.llm.near_copies import op6_near_copies
from tradeloom.llm.repeats import kept_text, least_places, op5_suffix_dedup
from tradeloom.llm.suffixes import common_prefixes, suffix_array


def prose(draw: random.Random, words: int) -> list[str]:
    return ["".join(draw.choice(["th", "er", "in", "on", "at", "en"]) for _ in range(draw.randint(1, 4))) for _ in range(words)]


def plain_sets(texts):
    upper = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    out = []
    for text in texts:
        words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(upper))
        out.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    return out


def plain_components(sets):
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(sets))]


def copied_texts() -> list:
    draw = random.Random(8)
    base, other = prose(draw, 300), prose(draw, 60)
    shared = prose(draw, 70)
    texts = [*AWKWARD, " ".join(base), " ".join(base).upper(), "\t".join(base) + "\n"]
    for edits in [1] * 25 + [3] * 25 + [6] * 25 + [9] * 20:
        words = list(base)
        for _ in range(edits):
            words[draw.randrange(len(words))] = prose(draw, 1)[0] + str(draw.random())
        texts.append(" ".join(words))
    chain = list(other)
    for _ in range(12):  # each is near the one before it, the ends are far apart
        chain = [*chain[1:], prose(draw, 1)[0]]
        texts.append(" ".join(chain))
    texts += [" ".join(prose(draw, 20) + shared + prose(draw, 20)) for _ in range(30)]
    texts += ["one two three four", "One  two three four", "one two three four five", "one two", "two one"]
    return texts


@pytest.mark.parametrize("block", [200_000, 2_000])
def test_near_copies(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK_SHINGLES", block)
    texts = copied_texts()
    rows, schema = documents(texts)
    rows += [rows[20], (None, *rows[20][1:])]
    found = op6_near_copies(spark, store(spark, tmp_path, documents=(rows, schema))).collect()
    sets = plain_sets(texts)
    wanted = plain_components(sets)
    assert len(found) == len(rows)
    for r in found:
        i = 20 if r.doc_id is None else r.doc_id
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[i]), wanted[i], r.doc_id == wanted[i])


def test_near_copies_of_given_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()}
    ids = sorted(texts)
    wanted = plain_components(plain_sets([texts[i] for i in ids]))
    found = {r.doc_id: r.component_id for r in op6_near_copies(spark, f"{DATA}/sf0.001").collect()}
    assert [found[i] for i in ids] == [ids[w] for w in wanted]


def test_components_of_random_links(spark):
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)] + [(500, i) for i in range(501, 600)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    named = {x for a, b in links if a != b for x in (a, b)}
    assert found == {x: root(x) for x in named if root(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 3, 256])
def test_suffix_array_and_prefixes(letters):
    draw = random.Random(letters)
    for size in (0, 1, 2, 9, 120, 333):
        data = bytes(draw.randrange(letters) for _ in range(size)) * draw.choice([1, 3])
        text = np.frombuffer(data, np.uint8)
        order = suffix_array(text, 10_000).tolist()
        assert order == sorted(range(len(data)), key=lambda i: data[i:])
        wanted = np.array([draw.random() < 0.3 for _ in data], bool)
        assert suffix_array(text, 10_000, wanted).tolist() == [i for i in order if wanted[i]]
        lengths = common_prefixes(text, np.array(order, np.int64), 10_000)
        for i in range(1, len(order)):
            a, b = data[order[i] :], data[order[i - 1] :]
            assert lengths[i] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_least_places():
    values = np.array([5, 3, 9, 3, 7, 1, 8, 1, 1, 6], np.uint64) << np.uint64(40)
    for span in (1, 2, 3, 7, 10):
        wanted = [i + int(np.argmin(values[i : i + span])) for i in range(len(values) - span + 1)]
        assert least_places(values, span).tolist() == wanted


def plain_repeats(texts, size=400):
    raw = [(t or "").encode() for t in texts]
    counts = {}
    for data in raw:
        for i in range(len(data) - size + 1):
            counts[data[i : i + size]] = counts.get(data[i : i + size], 0) + 1
    out = []
    for i, data in enumerate(raw):
        gone = np.zeros(len(data), bool)
        for k in range(len(data) - size + 1):
            if counts[data[k : k + size]] > 1:
                gone[k : k + size] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def repeating_texts() -> list:
    draw = random.Random(9)
    passage, exact, short = " ".join(prose(draw, 160)), " ".join(prose(draw, 90))[:400], " ".join(prose(draw, 90))[:399]
    texts = list(AWKWARD)
    for i in range(12):
        own = " ".join(prose(draw, 40 + i))
        texts.append(own + passage[i : 500 + 9 * i] + " ".join(prose(draw, 30)))
    texts += [f"{' '.join(prose(draw, 30))}{exact}{' '.join(prose(draw, 30))}" for _ in range(3)]
    texts += [f"{' '.join(prose(draw, 30))}{short}{' '.join(prose(draw, 30))}" for _ in range(3)]
    twice = " ".join(prose(draw, 150))
    texts += [twice + " between " + twice, "ä" * 900, "b" + "ä" * 300 + "c", "abc" * 400, "z" * 399, "z" * 400 + "y", "é" * 230 + "q" * 300]
    texts += [texts[15]] * 4
    near = prose(draw, 300)
    for _ in range(15):
        words = list(near)
        words[draw.randrange(300)] = "changed"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("most", [512, 1])
def test_repeats(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_SEGMENTS", most)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 20_000)
    texts = repeating_texts()
    found = op5_suffix_dedup(spark, store(spark, tmp_path, documents=documents(texts))).collect()
    assert sorted(map(tuple, found)) == plain_repeats(texts)


@pytest.mark.parametrize("size", [30, 240])
def test_repeats_of_other_lengths(spark, size):
    texts = repeating_texts()
    rows, schema = documents(texts)
    found = repeats.digest_removals(spark.createDataFrame(rows, schema), size).collect()
    assert sorted(map(tuple, found)) == plain_repeats(texts, size)


def test_passages_of_over_fifty_words_are_cut(spark):
    draw = random.Random(51)
    words = lambda n: " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(n))
    shared, clean = [words(52) for _ in range(20)], [words(150) for _ in range(20)]
    texts = clean + [f"{words(40)} {p} {words(40)}" for p in shared for _ in range(2)]
    rows, schema = documents(texts)
    kept = {r.doc_id: r.text for r in corpus_pipeline.repeats(spark, spark.createDataFrame(rows, schema), "").collect()}
    assert all(kept[i] == text for i, text in enumerate(clean))
    assert not any(p in kept[20 + 2 * i + j] for i, p in enumerate(shared) for j in (0, 1) if len(p) >= corpus_pipeline.REPEATED_BYTES)
    assert sum(len(p) >= corpus_pipeline.REPEATED_BYTES for p in shared) >= 18


def test_repeats_of_given_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()}
    ids = sorted(texts)
    found = {r[0]: tuple(r)[1:] for r in op5_suffix_dedup(spark, f"{DATA}/sf0.001").collect()}
    assert [found[i] for i in ids] == [r[1:] for r in plain_repeats([texts[i] for i in ids])]


def test_only_whole_characters_are_cut():
    assert kept_text("aéb", [2], [4]) == "aé"
    assert kept_text("aéb", [1], [4]) == "a"
    assert kept_text("aéb", [0], [3]) == "b"


@pytest.mark.parametrize("query", [op5_suffix_dedup, op6_near_copies])
def test_empty_table(spark, tmp_path, query):
    assert query(spark, store(spark, tmp_path, documents=documents([]))).count() == 0


def test_stages_keep_columns_and_act(spark, tmp_path):
    texts = copied_texts() + repeating_texts()[len(AWKWARD) :] + ["my token=abcdef0123 is here " + "x"]
    labels = ([(i, 1, 0) for i in range(0, len(texts), 2)], "doc_id long, quality int, toxic int")
    folder = store(spark, tmp_path, documents=documents(texts), labels=labels)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            kept[name] = {r.doc_id: r for r in docs.collect()}
            assert all(r.text is None or r.n_chars == len(r.text) for r in kept[name].values())
    ids = sorted(kept["quality"])
    wanted = plain_components(plain_sets([texts[i] for i in ids]))
    assert sorted(kept["near_copies"]) == sorted({ids[w] for w in wanted})
    before = [kept["near_copies"][i].text for i in sorted(kept["near_copies"])]
    removed = {i: r for i, r in zip(sorted(kept["near_copies"]), plain_repeats(before, corpus_pipeline.REPEATED_BYTES))}
    for i, r in kept["repeats"].items():
        assert (r.text == texts[i]) == (removed[i][2] == 0)
        assert len((texts[i] or "").encode()) - len((r.text or "").encode()) <= removed[i][2]
    assert kept["secrets"].keys() == kept["repeats"].keys()
    assert kept["secrets"][len(texts) - 1].text == "my [SECRET] is here x"
    assert {r.doc_id for r in docs.collect()} == set(kept["secrets"])


def test_one_row_of_each_component_stays(spark, tmp_path):
    draw = random.Random(9)
    long = [" ".join("w%d" % draw.randrange(10**6) for _ in range(120)) for _ in range(4)]
    rows, schema = documents([long[0], long[0] + " more", long[1], long[2], "", long[3]])
    rows += [rows[0], rows[2], rows[2], (None, *rows[3][1:]), rows[4], (None, *rows[4][1:]), (None, *rows[4][1:])]
    rows += [(5, "another text of this id", *rows[5][2:]), (None, "only without id", *rows[5][2:]), (None, "only without id", *rows[5][2:])]
    docs = spark.read.parquet(store(spark, tmp_path, documents=(rows, schema)) + "/documents.parquet")
    kept = near_copies.keep_first_copies(docs)
    assert kept.columns == docs.columns
    kept = corpus_pipeline.repeats(spark, kept, "").select("doc_id", "text").collect()
    wanted = [(0, long[0]), (2, long[1]), (3, long[2]), (4, ""), (None, ""), (None, ""), (5, long[3]), (5, "another text of this id"), (None, "only without id")]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, wanted))


def test_run_on_given_texts(spark):
    packed = corpus_pipeline.run(spark, f"{DATA}/sf0.001")
    assert packed.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    total = packed.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0]
    assert total == 2048


def test_pipeline_on_an_empty_table(spark, tmp_path):
    labels = ([], "doc_id long, quality int, toxic int")
    assert corpus_pipeline.run(spark, store(spark, tmp_path, documents=documents([]), labels=labels)).count() == 0
