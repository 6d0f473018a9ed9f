import random
import re

from innsight.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def windows_twice(words, n):
    """Places inside an n-word window that occurs at least twice."""
    places = {}
    for i in range(len(words) - n + 1):
        places.setdefault(tuple(words[i : i + n]), []).append(i)
    return {i + k for found in places.values() if len(found) > 1 for i in found for k in range(n)}


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    chars = sum(map(len, words))
    repeat = len(windows_twice(words, 3))
    dup_chars = sum(sum(map(len, WORD.findall(x))) for x in lines if lines.count(x) > 1)
    shares = [sum(len(words[i]) for i in windows_twice(words, n)) for n in (5, 6, 7, 8, 9, 10)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * repeat > 50 * len(words)
    kept = not failed and symbols <= 0.1 * len(words) and dup_chars <= 0.3 * chars and all(
        s <= most * chars for s, most in zip(shares, (0.40, 0.38, 0.36, 0.34, 0.32, 0.30)))
    return (len(words), chars, symbols, len(lines) - len(set(lines)), repeat, failed, kept, dup_chars, *shares)


def found(df):
    return sorted(((r.doc_id, tuple(r.quality)) for r in quality.with_quality(df).collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = sorted(((r.doc_id, brute(r.text)) for r in docs.collect()), key=str)
    assert found(docs) == want
    assert {w[1][6] for w in want} == {True, False}


def test_random_repeats(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        passage = [f"p{rng.randrange(30)}" for _ in range(12)]
        words = [w for _ in range(rng.randrange(1, 9)) for w in (passage if rng.random() < 0.5 else [f"w{rng.randrange(400)}é" for _ in range(15)])]
        rows.append((i, "".join(w + rng.choice([" ", " ", "\n", " # "]) for w in words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == sorted(((i, brute(t)) for i, t in rows), key=str)


def test_null_empty_very_long_repeated_and_clashing(spark):
    long = "one two three four five six " * 40_000
    single = "x" * 1_000_000
    rows = [(1, None), (2, ""), (3, " \t\n\x0b"), (4, long), (5, single), (6, "a\n\na\n \na"), (6, "a\n\na\n \na"), (None, "#*$ %&|<>")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words", "2 AS kept", "3 AS Quality")
    got = quality.with_quality(df)
    assert got.columns == ["doc_id", "text", "n_words", "kept", "quality"]
    got = {(r.doc_id, r.text): r for r in got.collect()}
    assert len(got) == 7 and all(r.n_words == 1 and r.kept == 2 for r in got.values())
    for i, text in rows:
        if text != long:
            assert tuple(got[i, text].quality) == brute(text)
    assert got[4, long].quality.n_repeat_words == got[4, long].quality.n_words == 240_000 and not got[4, long].quality.kept
    assert quality.with_quality(df.limit(0)).collect() == []
