"""Benchmark phrases found in documents by a distributed positional inverted index, in DataFrame functions only.

1. Item texts become word sequences; equal sequences are one phrase. A phrase's windows are
   its runs of ``window`` words, or the whole of a shorter phrase.
2. One pass over the documents writes the index: a posting (term, row, position) for every
   document word that some phrase holds. Each file indexes the documents of its own task
   and is sorted by term, so a reader of few terms skips the other pages; no word is shuffled.
3. Terms are counted in the index. The two rarest places of every window are its anchors.
   A posting of an anchor, shifted back by the anchor's place in the phrase, is an alignment
   (row, phrase, shift); alignments that fewer than two anchors share are dropped.
4. The lists of all other terms of a phrase are intersected with what is left, in the
   documents that still have an alignment. A run of matching places at least as long as a
   window is an exact match, and its words are hit.
5. Proximity: the ``near_terms`` rarest terms of an item within ``span`` consecutive words.

A table is broadcast only if its counted rows stay below ``MOST_BROADCAST``; larger ones are
joined by a shuffle, where adaptive execution splits a frequent term.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innsight.llm.tables import stored

WINDOW, SPAN, NEAR_TERMS = 10, 20, 3
MOST_BROADCAST = 500_000  # rows of a few numbers or one word, about 30 MB
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What words of letters, digits and characters beyond ASCII do not hold.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCUMENT = -1  # term of the one posting that every document has


def lowered(text: Column) -> Column:
    """A-Z lower-cased; the quick function where there is nothing but ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _cut(text: Column) -> Column:
    """An empty string, the words, and one more empty string after a separator at the end."""
    return F.split(F.concat(F.lit(" "), lowered(F.coalesce(text, F.lit("")))), BETWEEN)


def small(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df``, a stored table, to be broadcast if it is small enough."""
    return F.broadcast(df) if df.count() <= (MOST_BROADCAST if most is None else most) else df


def phrases(items: DataFrame, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(phrase, n, words) of the distinct word sequences, and (phrase, item) of the items that have them.

    Items without a word have no phrase. An item without an id has one that names nobody.
    """
    words = F.array_remove(_cut(F.col(f"`{text}`")), "")
    cut = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), words.alias("words")).where(F.size("words") > 0)
    cut = stored(cut.distinct(), "index-items")
    known = stored(cut.select("words").distinct().select(F.monotonically_increasing_id().alias("phrase"), F.size("words").alias("n"), "words"), "index-phrases")
    return known, cut.where("item IS NOT NULL").join(known, "words").select("phrase", "item").distinct()


def vocabulary(known: DataFrame) -> DataFrame:
    """(word, term): a number for each word of a phrase, and the mark of a document."""
    found = known.select(F.explode("words").alias("word")).distinct().select("word", F.monotonically_increasing_id().alias("term"))
    return stored(found.union(known.sparkSession.createDataFrame([("", DOCUMENT)], "word string, term long")), "index-terms")


def build_index(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_words, term, pos): postings of ``terms`` in whole texts, positions from 1.

    ``row`` numbers the rows of ``docs``, so that rows which share an id stay apart. Each row
    has one posting of the term ``DOCUMENT``, the only one with ``doc_id`` and ``n_words``; a
    null text has no other.
    """
    cut = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), _cut(F.col(f"`{text}`")).alias("words"))
    n_words = F.size("words") - 1 - F.when(F.element_at("words", -1) == "", 1).otherwise(0)
    places = cut.select("row", "doc_id", n_words.cast("long").alias("n_words"), F.posexplode("words").alias("pos", "word")).where("pos = 0 OR word <> ''")
    # Found by a number, which is quicker than by a string; the word itself is compared after
    # that, in a form that the optimizer does not turn into a second key.
    coded = terms.select(F.xxhash64("word").alias("code"), F.col("word").alias("same"), "term")
    postings = places.withColumn("code", F.xxhash64("word")).join(small(coded), "code").where("NOT (word < same OR word > same)")
    about = [F.when(F.col("term") == DOCUMENT, F.col(c)).alias(c) for c in ("doc_id", "n_words")]
    # One numeric key is sorted by radix, which keeps rows and places in order.
    return stored(postings.select("row", *about, "term", "pos").sortWithinPartitions("term"), "index")


def match(known: DataFrame, terms: DataFrame, index: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, phrase, pos): every document place that lies in an exact occurrence of a window."""
    counts = stored(index.where(F.col("term") != DOCUMENT).groupBy("term").agg(F.count(F.lit(1)).alias("held")), "index-counts")
    places = known.select("phrase", "n", F.posexplode("words").alias("q", "word")).join(terms, "word").join(counts, "term", "left")
    places = stored(places.select("phrase", "n", "q", "term", F.coalesce("held", F.lit(0)).alias("held")), "index-places")

    length = F.least("n", F.lit(window))
    starts = F.sequence(F.greatest(F.col("q") - length + 1, F.lit(0)), F.least("q", F.col("n") - length))
    windows = places.select("phrase", "n", "q", "term", "held", F.explode(starts).alias("start")).groupBy("phrase", "n", "start")
    rarest = windows.agg(F.slice(F.array_sort(F.collect_list(F.struct("held", "term", "q"))), 1, 2).alias("a"))
    anchors = rarest.where(F.col("a")[0]["held"] > 0).select("phrase", "n", F.explode("a").alias("a")).select("phrase", "n", "a.term", "a.q").distinct()
    anchors = stored(anchors, "index-anchors")

    postings = index.where(F.col("term") != DOCUMENT).select("term", "row", "pos")
    aligned = postings.join(small(anchors), "term").select("row", "phrase", "n", (F.col("pos") - F.col("q")).alias("shift"))
    aligned = aligned.groupBy("row", "phrase", "n", "shift").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= F.least("n", F.lit(2)))
    aligned = stored(aligned.select("row", "phrase", "n", "shift"), "index-aligned")

    left = stored(aligned.select("row").distinct(), "index-rows")
    probes = aligned.join(places.select("phrase", "q", "term"), "phrase").select("row", "phrase", "n", "shift", "q", "term", (F.col("shift") + F.col("q")).alias("pos"))
    matched = probes.join(postings.join(small(left), "row", "left_semi"), ["row", "term", "pos"])
    run = Window.partitionBy("row", "phrase", "shift").orderBy("q")
    matched = matched.select("row", "phrase", "n", "shift", "pos", (F.col("q") - F.row_number().over(run)).alias("run"))
    size = F.count(F.lit(1)).over(Window.partitionBy("row", "phrase", "shift", "run"))
    return matched.withColumn("size", size).where(F.col("size") >= length).select("row", "phrase", "pos")


def near(known: DataFrame, terms: DataFrame, index: DataFrame, near_terms: int = NEAR_TERMS, span: int = SPAN) -> DataFrame:
    """(row, phrase): all of a phrase's ``near_terms`` rarest distinct terms within ``span`` words, in any order."""
    counts = index.where(F.col("term") != DOCUMENT).groupBy("term").agg(F.count(F.lit(1)).alias("held"))
    words = known.select("phrase", F.explode(F.array_distinct("words")).alias("word")).join(terms, "word").join(counts, "term", "left")
    ranked = words.select("phrase", "term", "held", F.row_number().over(Window.partitionBy("phrase").orderBy(F.col("held").asc_nulls_first(), "word")).alias("rank"))
    ranked = ranked.where(F.col("rank") <= near_terms)
    each = Window.partitionBy("phrase")
    ranked = ranked.withColumns({"k": F.count(F.lit(1)).over(each), "found": F.count("held").over(each)}).where("k = found").select("phrase", "term", "rank", "k")
    postings = index.where(F.col("term") != DOCUMENT).select("term", "row", "pos").join(small(stored(ranked, "index-near")), "term")
    so_far = Window.partitionBy("row", "phrase").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [F.last(F.when(F.col("rank") == r, F.col("pos")), ignorenulls=True).over(so_far).alias(f"p{r}") for r in range(1, near_terms + 1)]
    seen = postings.select("row", "phrase", "k", "pos", *last)
    absent = [F.when(F.col("k") >= r, F.coalesce(f"p{r}", F.lit(-1 << 40))).otherwise(F.col("pos")) for r in range(1, near_terms + 1)]
    first = F.least(*absent) if len(absent) > 1 else absent[0]
    return seen.where(F.col("pos") - first < span).select("row", "phrase").distinct()


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, near_terms: int = NEAR_TERMS, span: int = SPAN,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items, contaminated, n_near): one row for each row of ``docs``.

    ``n_hit``: words inside any exact occurrence of an item's window. ``items``: the sorted
    ids, as strings, of items with an occurring window. ``n_near``: items whose rarest terms
    lie close together. A null, empty or wordless text has no words, no hits and no items;
    rows that repeat an id are judged one by one; a null id stays null. Items that repeat an
    id count once, items without a word match nothing, and an item without an id hits words
    but is not named. Columns beyond ids and texts are not read. Empty tables give no rows,
    or no hits.
    """
    known, named = phrases(items, item_id, item_text)
    terms = vocabulary(known)
    index = build_index(docs, terms, doc_id, text)
    hits = stored(match(known, terms, index, window), "index-hits")
    named = small(stored(named, "index-named"))
    n_hit = hits.select("row", "pos").distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    ids = hits.select("row", "phrase").distinct().join(named, "phrase").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    close = near(known, terms, index, near_terms, span).join(named, "phrase").groupBy("row").agg(F.count_distinct("item").alias("n_near"))
    found = n_hit.join(ids, "row", "full").join(close, "row", "full")
    found = small(stored(found, "index-found"))
    all_rows = index.where(F.col("term") == DOCUMENT).select("row", "doc_id", "n_words")
    none = F.array().cast("array<string>")
    return all_rows.join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )
