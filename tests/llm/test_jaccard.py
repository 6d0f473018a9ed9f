import random

import numpy as np
from brute import jaccard_components as brute

from innsight.llm import jaccard


def found(df, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, **options).collect()}


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert found(docs) == want
    assert found(docs, block=3, chunk_chars=5_000) == want
    assert any(i != c for i, (_, c) in want.items())


def test_chains_of_edits_at_the_threshold(spark):
    rng = random.Random(7)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]
    rows, shared = [], [f"s{k}" for k in range(60)]
    for i in range(60):
        words = list(base) if i % 3 else [f"u{i}x{k}" for k in range(rng.randrange(1, 90))] + shared
        for _ in range(rng.randrange(0, 16)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(50)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows)
    assert found(df, block=4, chunk_chars=3_000) == brute(rows)


def test_null_empty_repeated_and_clashing(spark):
    text = "One two three four five six seven eight"
    rows = [(1, text, 9), (2, None, 9), (3, "", 9), (4, " \t\n", 9), (5, text.upper(), 9), (6, "short one", 9), (7, "SHORT  one", 9), (None, text, 9), (5, text.upper(), 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=str)
    assert got == sorted([(1, 4, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 4, 1), (5, 4, 1), (6, 1, 6), (7, 1, 6), (None, 4, None)], key=str)
    assert jaccard.jaccard_components(df.limit(0)).collect() == []


def components_of(sets):
    """Brute force: the smallest set that each reaches by links."""
    root = list(range(len(sets)))
    for x, a in enumerate(sets):
        for y, b in enumerate(sets[:x]):
            if 100 * len(a & b) >= 75 * len(a | b) and root[x] != root[y]:
                old, new = max(root[x], root[y]), min(root[x], root[y])
                root = [new if r == old else r for r in root]
    return root


def test_a_block_searched_together_equals_brute_force(monkeypatch):
    """Sets near the threshold, many and few sharing a class, with the holders of classes as a matrix and as lists."""
    rng = random.Random(3)
    for m, universe, drop in ((2, 20, 4), (40, 60, 9), (60, 400, 60), (150, 90, 14)):
        groups = [rng.sample(range(1, universe), universe // 2) for _ in range(1 + m // 15)]
        sets = []
        for _ in range(m):
            own = set(rng.choice(groups))
            own -= set(rng.sample(sorted(own), min(len(own) - 1, rng.randrange(drop))))
            sets.append(own | {0} | {1000 + rng.randrange(5000) for _ in range(rng.randrange(3))})
        sizes = np.array([len(s) for s in sets])
        owners, keys = np.repeat(np.arange(m), sizes), np.array([k for s in sets for k in sorted(s)])
        want = components_of(sets)
        for most in (0, jaccard.MOST_DENSE):
            monkeypatch.setattr(jaccard, "MOST_DENSE", most)
            roots = jaccard._block(0, sizes, owners, keys, np.ones(len(keys), np.int32), 75)
            assert len({*zip(roots, want)}) == len({*want}) == len({*roots})


def test_few_classes_are_sent_to_a_block(spark, monkeypatch):
    """A block gets the classes from its own on."""
    sent = []
    monkeypatch.setattr(jaccard, "components", lambda edges, label: sent.append(edges) or spark.createDataFrame([], "node binary, root binary"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    jaccard.jaccard_components(docs).count()
    assert "array_position" in sent[0]._jdf.queryExecution().toString()


def test_viable_sets_are_found_with_one_shuffle_of_the_sets_at_most(spark, monkeypatch):
    """Few are broadcast, however low Spark's own threshold; for many the sets are shuffled and stored once, not for each reading."""
    plans, store = {}, jaccard.stored_at

    def noted(df, path):
        plans[path.rsplit("/", 1)[1][:-13]] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, path)

    monkeypatch.setattr(jaccard, "stored_at", noted)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        want = found(docs)
        assert "BroadcastHashJoin" in plans["jaccard-shared"] and "SortMergeJoin" not in plans["jaccard-shared"]
        monkeypatch.setattr(jaccard, "MOST_BROADCAST", 0)
        assert found(docs) == want
        assert "Join" not in plans["jaccard-shared"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
