"""Quality rules by repetition coverage.

Rolling hashes of several n-gram lengths measure which share of a text's word
characters lies inside n-grams that occur twice or more, and inside lines that do.
Every text is judged alone and whole, so there is no shuffle.

Defined results: a null or wordless text has zeros everywhere and fails the base rule;
equal texts get equal verdicts; row order and other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.text import WORD, batch_column, put, scrambled

SYMBOLS = "#*$%&|<>"
#: n-gram length -> largest share of word characters inside duplicated n-grams
MOST_REPEATED = {5: 0.40, 6: 0.38, 7: 0.36, 8: 0.34, 9: 0.32, 10: 0.30}
MOST_REPEATED_LINES = 0.30
MOST_SYMBOLS = 0.10
LEAST_WORDS = 50
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean,"
    " dup_line_chars long, " + ", ".join(f"dup_{n}gram_chars long" for n in MOST_REPEATED)
)


def repeated_words(hashes: np.ndarray, n: int, size: int) -> np.ndarray | None:
    """Which of ``size`` words lie in an n-word window found twice or more; None if none does."""
    if len(hashes) < 2:
        return None
    order = np.argsort(hashes)
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    if not same.any():
        return None
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(size + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + n, -1)
    return np.cumsum(edges[:-1]) > 0


def measure(text: str | None) -> tuple:
    """The columns of ``SCHEMA`` for one text."""
    text = text or ""
    found = WORD.findall(text)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    n_words, word_chars = len(found), int(lengths.sum())
    n_symbols = sum(map(text.count, SYMBOLS))
    seen: dict[str, int] = {}
    for line in text.split("\n"):
        if WORD.search(line):
            seen[line] = seen.get(line, 0) + 1
    again = {line: n for line, n in seen.items() if n > 1}
    n_dup_lines = sum(again.values()) - len(again)
    line_chars = sum(n * sum(map(len, WORD.findall(line))) for line, n in again.items())

    # Python's string hash serves inside one text only; windows roll over it.
    hashes = codes = scrambled(np.fromiter(map(hash, found), np.int64, n_words).view(np.uint64))
    n_repeat, shares, inside = 0, dict.fromkeys(MOST_REPEATED, 0), True
    for n in range(2, max(MOST_REPEATED) + 1):
        if n > n_words or inside is None:
            break
        hashes = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        if n == 3 or n in shares:
            inside = repeated_words(hashes, n, n_words)  # no repeat at this length: none at a greater one
            if inside is not None:
                if n == 3:
                    n_repeat = int(inside.sum())
                else:
                    shares[n] = int(lengths[inside].sum())
    base_failed = n_words < LEAST_WORDS or 100 * n_repeat > 50 * n_words
    kept = (
        not base_failed
        and n_symbols <= MOST_SYMBOLS * n_words
        and line_chars <= MOST_REPEATED_LINES * word_chars
        and all(shares[n] <= most * word_chars for n, most in MOST_REPEATED.items())
    )
    return (n_words, word_chars, n_symbols, n_dup_lines, n_repeat, base_failed, kept, line_chars, *shares.values())


def measured(texts: list[str | None]) -> pd.DataFrame:
    names = [part.split()[0] for part in SCHEMA.replace(", ", ",").split(",")]
    return pd.DataFrame([measure(t) for t in texts], columns=names)


def with_quality(df: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """``df`` with a struct of measures and the verdict ``kept`` as its last column."""
    return put(df, into, batch_column(SCHEMA, measured, F.col(f"`{text}`")))
