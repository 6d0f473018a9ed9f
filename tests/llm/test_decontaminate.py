import random
import re

from brute import lower

from innsight.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, window=10):
    """[(doc_id, n_words, n_hit, items)] by comparing every window with every place."""
    out = []
    cut = [(i, WORD.findall(lower(t))) for i, t in items]
    for doc_id, text in docs:
        words, hit, found = WORD.findall(lower(text)), set(), set()
        for item, want in cut:
            n = min(len(want), window)
            windows = {tuple(want[s : s + n]) for s in range(len(want) - n + 1)} if n else set()
            for p in range(len(words) - n + 1):
                if tuple(words[p : p + n]) in windows:
                    hit |= set(range(p, p + n))
                    found.add(item)
        out.append((doc_id, len(words), len(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=str)


def found(docs, items, **options):
    rows = decontaminate.contamination(docs, items, **options).collect()
    assert all(r.contaminated == (r.n_hit > 0) and r.n_items == len(r.items) for r in rows)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.items) for r in rows), key=str)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert found(docs, items) == want
    assert any(n for _, _, n, _ in want)


def test_few_words_that_overlap_and_repeat(spark, monkeypatch):
    rng = random.Random(11)
    items = [(k, " ".join(rng.choice("abc") for _ in range(rng.randrange(0, 9)))) for k in range(12)] + [(3, "A b, a"), (None, "c c c"), (50, None), (51, "zz")]
    docs = [(k % 25, " ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 60)))) for k in range(40)] + [(90, None), (91, ""), (92, " .,\n"), (None, "x c  c-C"), (93, "ZZ")]
    frame = frames(spark, docs, items)
    want = brute(docs, items, window=4)
    assert found(*frame, window=4) == want
    # The same by shuffles, as beyond the bound of a broadcast.
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", -1)
    assert found(*frame, window=4) == want


def test_very_long_text_and_case(spark):
    phrase = "Été über-all one two three four five six seven eight nine ten"
    docs = [(1, "filler word " * 150_000 + phrase + " tail"), (2, phrase.replace("É", "é")), (3, phrase.upper())]
    items = [(7, phrase)]
    assert found(*frames(spark, docs, items)) == brute(docs, items)


def test_terms_close_together_in_any_order(spark):
    items = [(1, "alpha beta gamma alpha"), (2, "delta missing"), (3, "beta")]
    docs = [(1, "gamma x x alpha x beta"), (2, "gamma " + "x " * 20 + "alpha beta"), (3, "delta"), (4, "alpha alpha alpha beta gamma"), (5, None)]
    rows = decontaminate.contamination(*frames(spark, docs, items), span=6).collect()
    assert {r.doc_id: r.n_near for r in rows} == {1: 2, 2: 1, 3: 0, 4: 2, 5: 0}


def test_empty_tables_and_clashing_columns(spark):
    docs, items = frames(spark, [(1, "a b"), (1, "a b")], [(1, "b")])
    wide = docs.selectExpr("*", "1 AS term", "2 AS pos", "3 AS n_hit", "4 AS row", "5 AS words", "6 AS phrase")
    assert found(wide, items.selectExpr("*", "9 AS doc_id", "8 AS n")) == [(1, 2, 1, ["1"])] * 2
    assert found(docs, items.limit(0)) == [(1, 2, 0, [])] * 2
    assert found(docs.limit(0), items) == []


def test_only_sql_functions(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "b")])
    plan = decontaminate.contamination(docs, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
