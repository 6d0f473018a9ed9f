import random
import re
import zlib
from collections import Counter

import numpy as np
from brute import lower
from hypothesis import given, settings
from hypothesis import strategies as st

from innsight.llm import variants


def brute_words(rows):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            if doc_id is not None and (h := zlib.crc32(f"{doc_id}:{run}".encode())) % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def edits(word, letters):
    out = {word[:k] + word[k + 1 :] for k in range(len(word))}
    out |= {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in letters}
    return (out | {word[:k] + c + word[k + 1 :] for k in range(len(word)) for c in letters}) - {word}


def brute(rows):
    words = brute_words(rows)
    letters = sorted(set("".join(words)))
    near = {w: [x for x in edits(w, letters) if x in words] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (n, form[w], words.get(form[w]), len(near[w]), root(w)) for w, n in words.items()}


def found(df, **options):
    rows = variants.spelling_variants(df, **options).collect()
    out = {r.word: (r.n, r.form, r.form_n, r.n_near, r.root) for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert found(docs) == want
    assert found(docs, groups=7, cell=50) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 500)
    try:  # cells that begin in one batch and end in another
        assert found(docs, cell=300, rows=800) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert any(form for _, form, _, _, _ in want.values()) and max(k for _, _, _, k, _ in want.values()) > 2


def test_dense_words_ties_and_chains(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abÿ") for _ in range(rng.randrange(6, 9))) for _ in range(300)]
    chain = ["queenlyx"] * 2 + ["queenly"] * 25 + ["queenlys"] * 250 + ["queenlysa"] * 2500
    rows = [(None, " ".join(chain)), (1, ".".join(words)), (2, " ".join(w.upper() for w in words)), (3, "1".join(words[::2]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert found(df) == want and want["queenlyx"][4] == "queenlysa"
    assert found(df, groups=2, cell=1) == want


def test_odd_texts_and_long_words(spark):
    long = "ab" * 60_000
    rows = [(1, None), (2, ""), (3, "12 !\n"), (4, f"{long} {long} {long}c {long}c {long[:-1]}d"), (4, f"{long[:-1]}d"), (5, "×÷" * 8 + " " + "×÷" * 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS cell")
    got = found(df, slip=2**40)
    assert {(len(w), w[-1]): v[3] for w, v in got.items()} == {(120_000, "b"): 2, (120_001, "c"): 1, (120_000, "d"): 1, (16, "÷"): 0}
    assert found(df.limit(0)) == {} and found(df.where("doc_id < 4")) == {}


@settings(max_examples=200, deadline=None)
@given(st.text("abcé", max_size=6), st.text("abcé", max_size=6))
def test_matrix_and_plain_comparison_agree(a, b):
    want = b in edits(a, "abcé")
    assert variants.one_edit(a, b) == want
    assert bool(len(variants.Spelling([a, b]).near(np.array([0]), np.array([1])))) == want
