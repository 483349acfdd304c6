import numpy as np
import pytest

from chainsift.llm import neighbours as M


def brute(rows, k=20, every=20):
    """{query: [(vec_id, score)]} by all inner products of rows with distinct ids."""
    rows = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for i, q in rows:
        if i % every == 0:
            found = sorted(((-float(q @ v), j) for j, v in rows if j != i))[:k]
            out[i] = [(j, -s) for s, j in found]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect()):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in found}) / len(found) for q, found in want.items()])


@pytest.mark.parametrize("kind", ["noise", "clusters", "norms", "shifted"])
def test_recall_against_all_pairs(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 48))
    if kind == "clusters":
        x = x * 0.3 + rng.standard_normal((30, 48))[rng.integers(0, 30, 3000)]
    if kind == "norms":
        x *= rng.lognormal(0, 0.7, (3000, 1))
    if kind == "shifted":
        x += 1.5
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    got, want = answers(M.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))), brute(rows)
    assert got.keys() == want.keys() and recall(got, want) >= 0.9
    for q, found in got.items():
        for j, s in found:
            assert s == pytest.approx(float(np.float64(np.float32(x[q])) @ np.float64(np.float32(x[j]))), rel=1e-12, abs=1e-12)


def test_several_cells_give_the_same_answers(spark, monkeypatch):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((2000, 16)))], "vec_id long, embedding array<double>").cache()
    monkeypatch.setattr(M, "CHUNK", 32)
    one = answers(M.nearest(df))
    monkeypatch.setattr(M, "CELL_ROWS", 40)
    cells = answers(M.nearest(df))
    assert recall(cells, one) > 0.95 and one.keys() == cells.keys()


def test_rows_that_take_no_part_ties_and_repeats(spark):
    ok = [(20, [1.0, 0.0]), (3, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, -9.0]), (40, [-1.0, 0.0])]
    odd = [(None, [1.0, 1.0]), (60, None), (80, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, None]), (8, []), (9, [9.0, 9.0, 9.0])]
    repeats = [(3, [0.5, 0.5]), (1, [0.5, -0.5])]
    df = spark.createDataFrame([(*r, 1, "x") for r in ok + odd + repeats], "vec_id long, embedding array<double>, rank int, score string")
    assert answers(M.nearest(df)) == {20: [(1, 0.5), (2, 0.5), (3, 0.5), (40, -1.0)], 40: [(1, -0.5), (2, -0.5), (3, -0.5), (20, -1.0)]}


def test_few_rows_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert M.nearest(spark.createDataFrame([], schema)).collect() == []
    assert M.nearest(spark.createDataFrame([(20, [1.0])], schema)).collect() == []
    assert M.nearest(spark.createDataFrame([(1, [1.0]), (2, [2.0])], schema)).collect() == []


def test_probing_holds_every_code_within_the_radius():
    rng = np.random.default_rng(7)
    codes, queries = rng.integers(0, 256, (500, 8), dtype=np.uint8), rng.integers(0, 256, (60, 8), dtype=np.uint8)
    queries[:30] = codes[:30] ^ (rng.random((30, 8)) < 0.3).astype(np.uint8)
    radius = rng.integers(0, 33, 60)
    found = np.unpackbits(M.Index(codes).probe(queries, radius), axis=1, count=500).astype(bool)
    distance = np.unpackbits(queries[:, None] ^ codes[None], axis=2).sum(axis=2)
    assert not (~found & (distance <= radius[:, None])).any()
    assert found[radius < 6].mean() < 0.2
