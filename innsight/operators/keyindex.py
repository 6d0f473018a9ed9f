"""Which parts of a stored table can hold a key: a Bloom filter and the key range of every part, kept as rows.

A filter is a list of 64-bit words. A key sets ``BITS`` bits of one word, so a question is one
join on the word; the number of words is a power of two near the number of keys times
``BITS_A_KEY`` / 64. A filter may name a part that does not hold the key, never the reverse.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, BITS_A_KEY, LEAST_WORDS = 5, 24, 64


def _word(code: Column, size: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(code, 32), size)


def _mask(code: Column) -> Column:
    """``BITS`` bits, from six bits of the lower half of the code each."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(code, 6 * k), F.lit(64)).cast("int")) for k in range(BITS)])


def _coded(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with all keys set, and their hash."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(known).withColumn("_code", F.xxhash64(*keys))


def build_key_index(rows: DataFrame, part: str, keys: Sequence[str]) -> DataFrame:
    """(part, size, word, bits, least, most): the filter words of each part and the range of its first key.

    ``rows`` holds the keys and ``part``; repeated keys change nothing. Rows with a null key are
    in no filter, as they match nothing. Two aggregations, the second one over words.
    """
    coded = _coded(rows.select(part, *keys), keys)
    sized = coded.groupBy(part).agg(F.count(F.lit(1)).alias("_n"), F.min(keys[0]).alias("least"), F.max(keys[0]).alias("most"))
    wanted = F.greatest(F.lit(LEAST_WORDS), F.ceil(F.col("_n") * BITS_A_KEY / 64))
    sized = sized.select(F.col(part).alias("_part"), F.pow(F.lit(2.0), F.ceil(F.log2(wanted))).cast("long").alias("size"), "least", "most")
    words = coded.join(sized, F.col(part) == F.col("_part")).select(part, "size", "least", "most", _word(F.col("_code"), F.col("size")).alias("word"), _mask(F.col("_code")).alias("_mask"))
    return words.groupBy(part, "size", "word").agg(F.bit_or("_mask").alias("bits"), F.first("least").alias("least"), F.first("most").alias("most"))


def parts_that_may_hold(index: DataFrame, batch: DataFrame, part: str, keys: Sequence[str]) -> DataFrame:
    """Distinct parts whose filter and key range admit a key of ``batch``."""
    coded = _coded(batch.select(*keys), keys).select(F.col(keys[0]).alias("_first"), "_code")
    sizes = [r.size for r in index.select("size").distinct().collect()]  # powers of two: a few
    asked = coded.withColumn("size", F.explode(F.array(*[F.lit(x) for x in sizes]).cast("array<long>")))
    asked = asked.select("_first", "size", _word(F.col("_code"), F.col("size")).alias("word"), _mask(F.col("_code")).alias("_mask"))
    met = index.join(asked, ["size", "word"]).where(F.col("bits").bitwiseAND(F.col("_mask")) == F.col("_mask")).where(F.col("_first").between(F.col("least"), F.col("most")))
    return met.select(part).distinct()
