import numpy as np
import pytest

from innsight.llm import ann


def brute(rows, wanted, k=20):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = np.array(sorted(good))
    base = np.array([good[i] for i in ids])
    out = {}
    for q in ids:
        if wanted(q):
            score = (base * good[q]).sum(1)
            at = [j for j in np.lexsort((ids, -score)) if ids[j] != q][:k]
            out[int(q)] = [(int(ids[j]), float(score[j])) for j in at]
    return out


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_recall_against_brute_force(spark, size):
    from innsight.llm.registered import op4_nearest

    folder = f"/root/testdata/{size}"
    want = brute([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()], lambda q: q % 20 == 0)
    got = {}
    for r in op4_nearest(spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    exact = {q: dict(v) for q, v in want.items()}
    assert np.mean([len({i for i, _ in got[q]} & exact[q].keys()) / 20 for q in want]) >= 0.95
    assert all(abs(s - exact[q][i]) < 1e-12 for q, v in got.items() for i, s in v if i in exact[q])


def test_blocks_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(300)]
    rows += [(300 + i, [1.0, 0.5, 0.25, 0.0, 0.0, 2.0]) for i in range(120)]  # one vector, many rows
    bad = [(1000, None), (1020, [0.0] * 6), (1040, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1060, [float("nan")] * 6), (1080, [float("inf")] * 6), (1100, [1.0]), (None, rows[0][1]), rows[20], (1120, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score", "2 AS part")
    plain = [(r.vec_id, r.embedding) for r in df.where("vec_id < 1000").collect()]
    for parts in (1, 4):
        got = {}
        for r in ann.search(df, df["vec_id"] % 20 == 0, parts=parts, rows=50, query_rows=4).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        want = brute(plain, lambda q: q % 20 == 0)
        assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
        if parts == 1:
            assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    few = ann.search(df.where("vec_id IN (0, 1, 2, 1000)"), df["vec_id"] % 20 == 0).collect()
    assert sorted((r.query_id, r["rank"]) for r in few) == [(0, 1), (0, 2)]
    assert ann.search(df.limit(0), df["vec_id"] % 20 == 0).collect() == []


def test_parts_are_balanced():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16)) * 4
    x = centres[rng.integers(0, 8, 1600)] + rng.normal(size=(1600, 16))
    part = ann.balanced_parts(x, ann.neighbours(x, 10), 8)
    assert np.bincount(part).max() <= np.ceil(1.1 * 200)
