"""Vector searches against brute force, with ties, repeats and unusable vectors."""

import numpy as np
import pytest
from cases import DATA, store

from tradeloom.llm.bit_slices import bit_sliced_top, op4_top_products
from tradeloom.llm.neighbours import nearest_in_cell, op10_nearest

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank int, block int"


def awkward_vectors() -> list[tuple]:
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in draw.normal(0, 0.2, 8)], 1, 0, 0, 0) for i in range(250)]
    copied = rows[7][1]
    rows += [(300 + i, copied, 1, 0, 0, 0) for i in range(14)]
    rows += [(400, None, 1, 0, 0, 0), (401, [0.0] * 8, 1, 0, 0, 0), (500, [0.0] * 8, 1, 0, 0, 0), (402, [1.0] * 7 + [None], 1, 0, 0, 0)]
    rows += [(403, [float("nan")] * 8, 1, 0, 0, 0), (404, [float("inf")] + [0.0] * 7, 1, 0, 0, 0), (None, copied, 1, 0, 0, 0)]
    rows += [(405, [1.0, 2.0], 1, 0, 0, 0), (406, [], 1, 0, 0, 0), (100, copied, 1, 0, 0, 0), (9, copied, 1, 0, 0, 0)]
    return rows


def brute(rows, zero: bool, products: bool) -> list[tuple]:
    good = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all()]
    good = [(i, v) for i, v in good if zero or v.any()]
    asked = {}
    for i, v in good:
        v = np.array(np.float32(v), float)
        if i % 100 == 0 and (i not in asked or tuple(v) < tuple(asked[i])):
            asked[i] = v
    out = []
    for q, v in asked.items():
        scored = []
        for i, w in good:
            w = np.array(np.float32(w), float)
            if i == q:
                continue
            if products:
                score = int((np.floor(1024 * v) * np.floor(1024 * w)).sum())
                scored.append((-score, i, score))
            else:
                score = float(np.sqrt(((w - v) ** 2).sum()))
                scored.append((score, i, score))
        out += [(q, rank, i, score) for rank, (_, i, score) in enumerate(sorted(scored)[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("query, zero, products", [(op4_top_products, True, True), (op10_nearest, False, False)])
def test_awkward_vectors(spark, tmp_path, query, zero, products):
    rows = awkward_vectors()
    found = sorted(map(tuple, query(spark, store(spark, tmp_path, embeddings=(rows, SCHEMA))).collect()))
    wanted = brute(rows, zero, products)
    assert [r[:3] for r in found] == [r[:3] for r in wanted]
    assert np.allclose([r[3] for r in found], [r[3] for r in wanted], rtol=1e-12, atol=0)


@pytest.mark.parametrize("query", [op4_top_products, op10_nearest])
def test_empty_table(spark, tmp_path, query):
    assert query(spark, store(spark, tmp_path, embeddings=([], SCHEMA))).count() == 0


@pytest.mark.parametrize("scale, columns, rows", [(0.1, 64, 900), (300.0, 5, 70), (0.001, 3, 40), (1.0, 16, 8)])
def test_kernels_are_exact(scale, columns, rows):
    draw = np.random.default_rng(5)
    vectors = draw.normal(0, scale, (rows, columns))
    vectors[: rows // 4] = vectors[0]
    ids, asked = np.arange(rows), np.arange(0, rows, 7)
    v = np.floor(1024 * vectors).astype(np.int64)
    found = list(zip(*bit_sliced_top(asked, vectors[asked], ids, vectors, 10)))
    for q in asked:
        wanted = sorted((-int(v[q] @ v[i]), i) for i in ids if i != q)[:10]
        assert sorted((-int(s), int(i)) for a, i, s in found if a == q) == wanted
    found = list(zip(*nearest_in_cell(asked, vectors[asked], ids, vectors, 10)))
    for q in asked:
        wanted = sorted((float(np.sqrt(((vectors[i] - vectors[q]) ** 2).sum())), i) for i in ids if i != q)[:10]
        assert sorted((float(s), int(i)) for a, i, s in found if a == q) == wanted


def test_recall_on_given_vectors(spark):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{DATA}/sf0.01/embeddings.parquet").collect()]
    found = op10_nearest(spark, f"{DATA}/sf0.01").collect()
    hits = 0
    for q, v in rows:
        if q % 100 == 0:
            near = sorted((np.sqrt(((w - v) ** 2).sum()), i) for i, w in rows if i != q)[:10]
            hits += len({i for _, i in near} & {r.vec_id for r in found if r.query_id == q})
    assert hits == len(found)


@pytest.mark.parametrize("columns", [64, 1536, 3072])
def test_near_vectors_on_a_grid(columns):
    draw = np.random.default_rng(6)
    base = draw.integers(-60, 60, columns)
    whole = np.tile(base, (600, 1))
    whole[np.arange(600)[:, None], draw.integers(0, columns, (600, 3))] += draw.integers(-1, 2, (600, 3))
    vectors = whole * 0.1
    ids = draw.permutation(600)
    asked = np.arange(0, 600, 25)
    found = list(zip(*nearest_in_cell(ids[asked], vectors[asked], ids, vectors, 10)))
    for q in asked:
        exact = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        wanted = sorted((float(d), int(i)) for d, i in zip(exact, ids) if i != ids[q])[:10]
        assert sorted((float(s), int(i)) for a, i, s in found if a == ids[q]) == wanted
