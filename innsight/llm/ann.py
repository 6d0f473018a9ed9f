"""Nearest neighbours by learned partitions.

On a bounded sample (``most_vectors`` rows with the smallest hash of their id) the exact
neighbour graph is cut into balanced parts with few edges between them. A small network
learns, from a vector alone, the distribution of its neighbours over the parts. Every row of
the table is indexed in its most probable part; a query visits its several most
probable parts, and all rows found there are ranked by the exact inner product. How many
parts a query visits is the least number that finds ``TARGET`` of the neighbours of sample
vectors the network was not trained on.

A part is split into blocks of rows and its queries into blocks of queries, and every pair
is one group, so a part that holds a third of the rows, or one vector that thousands of rows
repeat, is spread over many tasks.

Defined results: vectors that are null, zero, of another length than most of the sample,
or hold null or non-finite components take no part, nor do rows without an id; rows that
repeat id and vector count once; ties go to the smaller id; a query sees every candidate
if its parts hold fewer than ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.llm.tables import stored

MOST_VECTORS, PARTS, NEIGHBOURS, HIDDEN, TARGET = 6000, 16, 10, 64, 0.97
ROWS, QUERIES = 16_384, 2_048  # of a block


@dataclass
class Router:
    """Two-layer network from a scaled vector to the log-odds of each part."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int = 1

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """Parts of each vector, the most probable first."""
        hidden = np.maximum(scaled(vectors) @ self.w1 + self.b1, 0)
        return np.argsort(-(hidden @ self.w2 + self.b2), axis=1, kind="stable")


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Unit length, and the logarithm of the length as one more input."""
    top = np.abs(vectors).max(1, keepdims=True)
    unit = vectors / top
    length = np.sqrt((unit**2).sum(1, keepdims=True))
    return np.hstack([unit / length, np.log(length) + np.log(top)])


def neighbours(vectors: np.ndarray, k: int, queries: np.ndarray | None = None) -> np.ndarray:
    """Rows of the ``k`` largest inner products of each query row with the other rows."""
    queries = np.arange(len(vectors)) if queries is None else queries
    k, out = min(k, len(vectors) - 1), []
    for a in range(0, len(queries), 512):
        own = queries[a : a + 512]
        near = vectors[own] @ vectors.T
        near[np.arange(len(own)), own] = -np.inf
        out.append(np.argpartition(-near, k - 1, axis=1)[:, :k] if k else np.zeros((len(own), 0), int))
    return np.vstack(out)


def balanced_parts(vectors: np.ndarray, graph: np.ndarray, parts: int, sweeps: int = 12, slack: float = 1.1) -> np.ndarray:
    """Parts of about equal size with few graph edges between them.

    Halving along the widest direction gives balance; then vertices move to the part that
    holds most of their neighbours, the greatest gain first, while there is room.
    """
    n, part = len(vectors), np.zeros(len(vectors), int)
    while (groups := part.max() + 1) < min(parts, n):
        for g in range(groups):
            own = np.flatnonzero(part == g)
            centred = vectors[own] - vectors[own].mean(0)
            axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            part[own[np.argsort(centred @ axis, kind="stable")[len(own) // 2 :]]] += groups
    room = int(np.ceil(slack * n / (part.max() + 1)))
    heads, tails = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    for _ in range(sweeps):
        votes = np.zeros((n, part.max() + 1))
        np.add.at(votes, (heads, part[tails]), 1)
        np.add.at(votes, (tails, part[heads]), 1)
        best, moved = votes.argmax(1), 0
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        size = np.bincount(part, minlength=votes.shape[1])
        for x in np.argsort(-gain, kind="stable"):
            if gain[x] <= 0:
                break
            if size[best[x]] < room:
                size[part[x]] -= 1
                size[best[x]] += 1
                part[x] = best[x]
                moved += 1
        if not moved:
            break
    return part


def train_router(vectors: np.ndarray, wanted: np.ndarray, hidden: int = HIDDEN, epochs: int = 40) -> Router:
    """Fit the network to the distributions ``wanted`` (rows sum to 1)."""
    rng, x = np.random.default_rng(11), scaled(vectors)
    theta = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, wanted.shape[1])), np.zeros(wanted.shape[1])]
    m, v, step = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            own = order[a : a + 256]
            h = np.maximum(x[own] @ theta[0] + theta[1], 0)
            z = h @ theta[2] + theta[3]
            p = np.exp(z - z.max(1, keepdims=True))
            gap = (p / p.sum(1, keepdims=True) - wanted[own]) / len(own)
            back = (gap @ theta[2].T) * (h > 0)
            step += 1
            for k, g in enumerate((x[own].T @ back, back.sum(0), h.T @ gap, gap.sum(0))):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g**2
                theta[k] = theta[k] - 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Router(*theta)


def fit_router(vectors: np.ndarray, parts: int = PARTS, k: int = 20, target: float = TARGET) -> Router:
    """Router learnt from sample vectors; a sample too small to part has one part."""
    parts = min(parts, max(1, len(vectors) // 16))
    graph = neighbours(vectors, NEIGHBOURS) if len(vectors) > 1 else np.zeros((len(vectors), 0), int)
    part = balanced_parts(vectors, graph, parts) if parts > 1 else np.zeros(len(vectors), int)
    wanted = np.zeros((len(vectors), int(part.max(initial=0)) + 1))
    wanted[np.arange(len(vectors)), part] = 1
    np.add.at(wanted, (np.repeat(np.arange(len(vectors)), graph.shape[1]), part[graph.ravel()]), 1)
    wanted /= wanted.sum(1, keepdims=True)
    fold = np.arange(len(vectors)) % 5 == 0
    router = train_router(vectors[~fold], wanted[~fold])
    order = router.order(vectors)
    tested = np.flatnonzero(fold)
    near = neighbours(vectors, k, tested) if len(vectors) > 1 else np.zeros((1, 0), int)
    router.probes = wanted.shape[1]
    for probes in range(1, wanted.shape[1]):
        if near.size and np.mean((order[tested, :probes, None] == order[near, 0][:, None, :]).any(1)) >= target:
            router.probes = probes
            break
    return router


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(vector, lambda x: F.coalesce(finite(x), F.lit(False))) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _parts(router: Router):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(router.order(np.stack(batch.to_list()).astype(float)).astype(np.int32)) if len(batch) else [], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<int>").asNondeterministic()


def _nearest(k: int):
    def run(key: tuple, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """The ``k`` best rows of one block for each query of one block."""
        out = []
        if len(queries) and len(rows):
            ids, base = rows["vec_id"].to_numpy(np.int64), np.stack(rows["vector"].to_list()).astype(float)
            for a in range(0, len(queries), 256):
                part = queries.iloc[a : a + 256]
                own = np.stack(part["vector"].to_list()).astype(float)
                near = own @ base.T
                near[part["query_id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
                for q, vector, line in zip(part["query_id"], own, near):
                    least = np.partition(line, len(line) - k)[len(line) - k] if len(line) > k else -np.inf
                    # Rows as near as the last one, within rounding, are summed in one fixed order.
                    at = np.flatnonzero((line >= least - 1e-9 * max(1.0, abs(least))) & (line > -np.inf)) if least > -np.inf else np.flatnonzero(line > -np.inf)
                    score = (base[at] * vector).sum(1)
                    best = np.lexsort((ids[at], -score))[:k]
                    out += zip([q] * len(best), ids[at][best], score[best])
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def search(
    table: DataFrame, queries: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, parts: int = PARTS, most_vectors: int = MOST_VECTORS,
    rows: int = ROWS, query_rows: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that fulfils ``queries``, its nearest other rows."""
    own = table.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks"))
    own = own.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).dropDuplicates(["vec_id", "vector"])
    sample = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most_vectors).select("vector").toPandas()["vector"].to_list()
    dims = max(set(map(len, sample)), key=lambda d: (sum(len(v) == d for v in sample), d)) if sample else 0
    fitted = np.stack([v for v in sample if len(v) == dims]).astype(float) if sample else np.ones((1, 1))
    router = fit_router(fitted, parts, k)

    index = own.where(F.size("vector") == dims).withColumn("order", _parts(router)(F.col("vector")))
    index = stored(index.withColumn("part", F.col("order")[0]), "ann-index")
    # One row for each part.
    sizes = {r["part"]: (r["n"], r["q"]) for r in index.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).collect()}
    held = F.create_map(*[F.lit(x) for p in range(router.w2.shape[1]) for x in (p, sizes.get(p, (0, 0))[0])])
    enough = F.aggregate(
        "order", F.struct(F.lit(0).cast("long").alias("rows"), F.lit(0).alias("visits")),
        lambda a, p: F.when((a["visits"] < router.probes) | (a["rows"] <= k), F.struct((a["rows"] + held[p]).alias("rows"), (a["visits"] + 1).alias("visits"))).otherwise(a),
    )["visits"]
    asks = index.where("asks").select(F.col("vec_id").alias("query_id"), "vector", F.explode(F.slice("order", 1, enough)).alias("part"))
    asks = stored(asks, "ann-asks")
    wanted = {r["part"]: r["q"] for r in asks.groupBy("part").agg(F.count(F.lit(1)).alias("q")).collect()}
    blocks = F.create_map(*[F.lit(x) for p in range(router.w2.shape[1]) for x in (p, max(1, -(-sizes.get(p, (0, 0))[0] // rows)))])
    asked = F.create_map(*[F.lit(x) for p in range(router.w2.shape[1]) for x in (p, max(1, -(-wanted.get(p, 0) // query_rows)))])

    spread = lambda c, n, seed: F.pmod(F.xxhash64(c, F.lit(seed)), n).cast("int")
    left = asks.withColumn("i", spread("query_id", asked[F.col("part")], 1)).withColumn("j", F.explode(F.sequence(F.lit(0), blocks[F.col("part")] - 1)))
    right = index.select("vec_id", "vector", "part").withColumn("j", spread("vec_id", blocks[F.col("part")], 2)).withColumn("i", F.explode(F.sequence(F.lit(0), asked[F.col("part")] - 1)))
    keys = ["part", "i", "j"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_nearest(k), "query_id long, vec_id long, score double")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
