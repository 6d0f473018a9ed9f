"""URL verdicts: host and path rules, and a bit-parallel wildcard automaton for the rest.

All glob rules are packed into the bits of a few 64-bit words. One Shift-And step per
character moves every pattern at once over every URL of a batch: a bit stands for "the
pattern is matched up to here", a star keeps its bit alive, and a carry leads from word
to word. A URL is judged alone, so there is no shuffle and a host with a third of the rows
is spread like any other.

Canonical URL: host without user, port and closing dot, then the path ("/" if empty), then
"?" and the query without tracking parameters, without fragment. Defined results: a null
URL or one without "://" has empty host and path and the canonical form "/"; equal
URLs have equal verdicts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.llm.text import put

#: (host, path, verdict); the longest host and path that fit decide.
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: (pattern over the canonical URL, verdict). "*" is any run, "?" any character. Among those
#: that match, the one with most literal characters decides, block before allow.
GLOBS = (
    ("ads.*", "block"), ("ads-*", "block"), ("*.ads.*", "block"), ("*.ads-*", "block"), ("*tracker.*/*", "block"), ("*doubleclick*", "block"),
    ("*/ads/*", "block"), ("*/banner/*", "block"), ("*/popup/*", "block"), ("*.exe", "block"), ("*.zip", "block"), ("*.apk", "block"),
    ("*.gov/*", "allow"), ("*.edu/*", "allow"), ("*.org/de/*", "allow"), ("*.org/??/*.html", "allow"), ("*/wiki/*", "allow"), ("*/login*", "block"), ("*/cart/*", "block"),
)
DEFAULT = "allow"


class Automaton:
    """Shift-And over anchored globs: ``match`` gives one boolean for each URL and pattern."""

    def __init__(self, patterns: tuple[str, ...]):
        self.patterns, bits = patterns, []  # (character or None, whether a star follows)
        self.ends, self.empty_star, begins = [], [], []
        for pattern in patterns:
            begins.append(len(bits))
            bits.append((False, False))  # the start; holds before the first character
            for c in pattern:
                if c == "*":
                    bits[-1] = (bits[-1][0], True)
                else:
                    bits.append((None if c == "?" else c, False))
            self.ends.append(len(bits) - 1)
        self.width = -(-len(bits) // 64) if bits else 0
        self.alphabet = {c for c, _ in bits if c}
        self.code = {c: k + 1 for k, c in enumerate(sorted(self.alphabet))}  # 0: any other character
        self.masks = np.zeros((len(self.code) + 1, self.width), np.uint64)
        self.first, self.stay = np.zeros(self.width, np.uint64), np.zeros(self.width, np.uint64)
        for k, (c, star) in enumerate(bits):
            word, bit = divmod(k, 64)
            one = np.uint64(1 << bit)
            if c is None:
                self.masks[:, word] |= one
            elif c:
                self.masks[self.code[c], word] |= one
            if star:
                self.stay[word] |= one
        for k in begins:
            self.first[k // 64] |= np.uint64(1 << (k % 64))

    def match(self, urls: list[str]) -> np.ndarray:
        lengths = np.fromiter(map(len, urls), np.int64, len(urls))
        order = np.argsort(-lengths, kind="stable")
        sizes = lengths[order]
        flat = np.fromiter((self.code.get(c, 0) for i in order for c in urls[i]), np.int32, int(sizes.sum()))
        begin = np.cumsum(sizes) - sizes
        state = np.tile(self.first, (len(urls), 1))
        for t in range(int(sizes[0]) if len(sizes) else 0):
            n = int(np.searchsorted(-sizes, -t, side="left"))  # URLs longer than t
            own = state[:n]
            moved = own << np.uint64(1)
            moved[:, 1:] |= own[:, :-1] >> np.uint64(63)
            # A start bit is masked out here: no pattern begins twice.
            state[:n] = (moved & self.masks[flat[begin[:n] + t]]) | (own & self.stay)
        ends = np.array(self.ends, np.int64)
        found = np.zeros((len(urls), len(ends)), bool)
        if len(ends) and len(urls):
            found[order] = (state[:, ends // 64] >> (ends % 64).astype(np.uint64)) & np.uint64(1) == 1
        return found


def host(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; empty without one."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column, host_name: str, path_name: str) -> Column:
    """Host, path and query in one spelling; ``host_name`` and ``path_name`` are columns already cut."""
    plain = F.regexp_replace(F.regexp_replace(F.col(host_name), r"^.*@", ""), r"(:[0-9]*)?$|\.(:[0-9]*)?$", "")
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(r"^(utm_[a-z]*|gclid|fbclid|ref)(=|$)") & (p != "")), "&")
    return F.concat(plain, F.when(F.col(path_name) == "", "/").otherwise(F.col(path_name)), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def fitting_rule(host_name: str, path_name: str, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits the host or a parent of it and the start of the path, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):  # the longest is tried first
        fits = ((F.col(host_name) == h) | F.col(host_name).endswith("." + h)) & F.col(path_name).startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


@lru_cache(maxsize=4)
def _automaton(patterns: tuple[str, ...]) -> Automaton:
    return Automaton(patterns)


def glob_verdict(url: Column, globs=GLOBS, default: str = DEFAULT) -> Column:
    """Struct of the deciding pattern (null if none matches) and the verdict."""
    ranked = sorted(globs, key=lambda g: (-sum(c not in "*?" for c in g[0]), g[1] != "block", g[0]))
    patterns, verdicts = tuple(g[0] for g in ranked), np.array([g[1] for g in ranked] + [default], object)
    names = np.array([*patterns, None], object)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _automaton(patterns).match([u if isinstance(u, str) else "" for u in batch])
            first = np.where(found.any(1), found.argmax(1), len(patterns)) if len(patterns) else np.zeros(len(batch), int)
            yield pd.DataFrame({"glob": names[first], "verdict": verdicts[first]})

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "glob string, verdict string")(url)


def with_verdict(df: DataFrame, url: str = "url", into: str = "judged", rules=RULES, globs=GLOBS, default: str = DEFAULT) -> DataFrame:
    """``df`` with a struct (host, path, canonical, rule, glob, verdict) as its last column.

    A fitting rule decides; without one, the automaton over the canonical URL does.
    """
    source = F.col(f"`{url}`")
    out = put(df, "__judge_host", host(source)).withColumn("__judge_path", path(source))
    rule, verdict = fitting_rule("__judge_host", "__judge_path", rules)
    out = out.withColumn("__judge_canonical", canonical(source, "__judge_host", "__judge_path")).withColumn("__judge_glob", glob_verdict(F.col("__judge_canonical"), globs, default))
    parts = [F.col("__judge_host").alias("host"), F.col("__judge_path").alias("path"), F.col("__judge_canonical").alias("canonical"), rule.alias("rule"),
             F.when(rule.isNull(), F.col("__judge_glob.glob")).alias("glob"), F.coalesce(verdict, F.col("__judge_glob.verdict")).alias("verdict")]
    out = out.withColumn("__judged", F.struct(*parts))
    return put(out.select(*[f"`{c}`" for c in df.columns if c.lower() != into.lower()], "__judged"), into, F.col("__judged")).drop("__judged")
