"""Words of a text and the column helpers every operator here shares."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text: str) -> str:
    """Lower-case A-Z only; every other character stays."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def rolling(codes: np.ndarray, n: int) -> np.ndarray:
    """Order-dependent 64-bit hash of each window of ``n`` codes."""
    size = len(codes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    out = codes[:size].copy()
    for k in range(1, n):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += codes[k : size + k]
    return scrambled(out)


def scrambled(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (finaliser of splitmix64)."""
    out = values ^ (values >> np.uint64(30))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def slices(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose lengths sum to about ``most``; a longer item stands alone."""
    begin = total = 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield begin, len(lengths)


_KEPT: dict[str, Callable[[], None]] = {}
_turn: list[str] = [""]


def keeps(owner: str, clear: Callable[[], None]) -> None:
    """Name what drops the caches of ``owner`` in a Python worker."""
    _KEPT[owner] = clear


def turn_to(owner: str) -> None:
    """Drop what other operators keep in this worker, which Spark uses again for the next stage, and give the memory back."""
    if _turn[0] == owner:
        return
    for name, clear in _KEPT.items():
        if name != owner:
            clear()
    _turn[0] = owner
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def batch_column(schema: str, of: Callable[[list], pd.DataFrame | pd.Series], *columns: Column, most_chars: int = 4_000_000) -> Column:
    """Column computed by ``of`` over lists of texts, in Arrow batches cut to ``most_chars``.

    Marked non-deterministic only so that a filter on the result does not evaluate it a
    second time; ``of`` itself must give the same answer for the same text.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch]
            parts = [of(texts[a:b]) for a, b in slices([len(t or "") for t in texts], most_chars)]
            yield pd.concat(parts, ignore_index=True) if parts else of([])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, schema).asNondeterministic()(*columns)


def put(df: DataFrame, into: str, column: Column) -> DataFrame:
    """``df`` with ``column`` named ``into`` as its last column; a column of that name gives way."""
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != into.lower()]
    return df.select(*kept, column.alias(into))
