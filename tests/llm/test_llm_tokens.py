"""Encoding, decoding and packing against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from cases import AWKWARD, DATA, documents, store
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradeloom.llm import packing
from tradeloom.llm.bpe import VOCABULARY, Bpe, encode_documents, op9_bpe
from tradeloom.llm.packing import op7_packing, pack_rests, powers_of_two

PATH = public_tokenizers.path(VOCABULARY)
REFERENCE = Tokenizer.from_file(PATH)
BPE = Bpe(PATH)


def reference_ids(text: str) -> list[int]:
    return REFERENCE.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    ids = np.frombuffer(BPE.encode_batch([text])[0], "<u4")
    assert ids.tolist() == reference_ids(text)
    assert BPE.decode(ids) == REFERENCE.decode(ids.tolist(), skip_special_tokens=False)


@pytest.mark.parametrize("word", ["a" * 257, "ab" * 700, "é" * 600, "xyz1" * 90, "=" * 1000])
def test_long_words(word):
    assert np.frombuffer(BPE.encode_batch([word])[0], "<u4").tolist() == reference_ids(word)


def digest_rows(texts):
    out = []
    for i, text in enumerate(texts):
        ids = reference_ids(text or "")
        decoded = REFERENCE.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return out


def test_query_on_awkward_texts(spark, tmp_path):
    found = op9_bpe(spark, store(spark, tmp_path, documents=documents(AWKWARD)))
    assert sorted(map(tuple, found.collect())) == digest_rows(AWKWARD)


def test_query_on_given_texts(spark):
    rows = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").orderBy("doc_id").collect()
    found = {r[0]: tuple(r)[1:] for r in op9_bpe(spark, f"{DATA}/sf0.001").collect()}
    assert [found[r.doc_id] for r in rows] == [r[1:] for r in digest_rows([r.text for r in rows])]


def test_round_trip_of_operator(spark, tmp_path):
    folder = store(spark, tmp_path, documents=documents(AWKWARD))
    rows = encode_documents(spark.read.parquet(f"{folder}/documents.parquet"), PATH).collect()
    assert {r.doc_id: r.decoded for r in rows} == {i: t or "" for i, t in enumerate(AWKWARD)}


def check_packing(rows, texts: dict):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for doc_id, pieces in by_doc.items():
        ids, at = np.array([*reference_ids(texts[doc_id] or ""), 1], "<u4"), 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0


def test_packing_of_awkward_texts(spark, tmp_path):
    folder = store(spark, tmp_path, documents=documents(AWKWARD))
    check_packing(op7_packing(spark, folder).collect(), dict(enumerate(AWKWARD)))


def test_packing_of_given_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()}
    check_packing(op7_packing(spark, f"{DATA}/sf0.001").collect(), texts)


@pytest.mark.parametrize("query", [op7_packing, op9_bpe])
def test_empty_table(spark, tmp_path, query):
    assert query(spark, store(spark, tmp_path, documents=documents([]))).count() == 0


def test_neighbours_fill_windows_in_their_order():
    near = {0: [0, 3, 1, 2], 1: [1, 2, 3, 0], 2: [2, 1, 3, 0], 3: [3, 0, 1, 2]}
    windows = pack_rests([2000, 1000, 900, 48], lambda i: near[i])
    assert windows[0] == [(0, 0, 2000), (3, 0, 48)]
    assert windows[1] == [(1, 0, 1000), (2, 0, 900)]


def test_a_neighbour_is_cut_to_fill_a_window():
    windows = pack_rests([2000, 1500], lambda i: [i, 1 - i])
    assert windows == [[(0, 0, 2000), (1, 0, 48)], [(1, 48, 1452)]]
    assert [sum(n for *_, n in w) for w in powers_of_two(windows[1])] == [1024, 256, 128, 32, 8, 4]


def test_rests_that_share_rare_words_share_a_shard(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 16)
    draw = np.random.default_rng(4)
    texts, topics = [], []
    for i in range(640):
        topic = int(draw.integers(40))
        words = [f"topic{topic * 977 + j}x" for j in range(12)] + ["common"] * 3 + [f"n{i}"]
        texts.append(" ".join(draw.permutation(words)))
        topics.append(topic)
    folder = store(spark, tmp_path, documents=documents(texts))
    rows = op7_packing(spark, folder).collect()
    check_packing(rows, dict(enumerate(texts)))
    shards = {}
    for r in rows:
        shards.setdefault(r.sequence_id >> 16, set()).add(r.doc_id)
    assert len(shards) >= 40
    together = sum(topics[a] == topics[b] for s in shards.values() for a in s for b in s if a < b)
    of_all = sum(len(s) * (len(s) - 1) // 2 for s in shards.values())
    assert together > 0.2 * of_all


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([" ", " ", "  ", "\n", "\t", "\x85", "　", "\x1c", "a", "'s", "1", "!", "é", "🎉", "<|endoftext|>"]), max_size=12).map("".join), max_size=8))
def test_texts_encoded_by_distinct_words(texts):
    found = packing.encoder_of(PATH).many(pa.array([None, *texts], pa.string()))
    assert [ids.tolist() for ids in found] == [[], *map(reference_ids, texts)]


def test_a_word_that_comes_again_is_encoded_once(monkeypatch):
    encoder, given_letters = packing.Encoder(PATH), []

    class Counting:
        def encode_to_numpy(self, text, table=encoder.table, **how):
            given_letters.append(len(text))
            return table.encode_to_numpy(text, **how)

    monkeypatch.setattr(encoder, "table", Counting())
    texts = [f"text{i} " + "the same words in all of the texts, again and again " * 20 + "end" for i in range(50)]
    assert [ids.tolist() for ids in encoder.many(pa.array(texts))] == [reference_ids(t) for t in texts]
    assert sum(given_letters) < 0.02 * sum(map(len, texts))


def test_key_takes_the_smaller_of_equally_heavy_ids():
    draw = np.random.default_rng(5)
    idf = draw.integers(0, 4, 300).astype(float)
    hashes, last = draw.integers(-(1 << 60), 1 << 60, 300), np.zeros(300, np.int64)
    for size in (1, 5, 40, 400):
        ids = draw.integers(0, 300, size).astype("<u4")
        found, counts = np.unique(ids, return_counts=True)
        weight = idf[found] * counts * 2.2 / (counts + 1.2 * (0.25 + 0.75 * size / 50))
        heavy = [i for w, i in sorted(zip(-weight, found))[: packing.KEY_IDS] if w < 0]
        wanted = sorted(hashes[heavy])[:3]
        assert packing.lexical_key(ids, idf, 50.0, hashes, last) == [*wanted, 0, 0, 0][:3]
