"""Packing by lexical retrieval.

Document frequencies, number of documents and mean length are those of all documents. A
document goes to the shard of its highest-weight id, so that related documents of any file
meet; ids of few documents share a shard, and an id of more than ``block_tokens`` ids of
documents is split by hash of document. Shards are taken in blocks of about
``block_tokens`` ids, each with a BM25 inverted index over token ids. A window starts with a seed, the rest of a
cut document or the next unused one, and takes the unused documents that BM25 ranks
nearest to the seed until it is full; the last one is cut and its rest seeds the next
window, so a full window has no padding. What is left at the end of a block seeds the next
block. The last window of a task is cut into powers of two, which need no padding.

Every document crosses the network once, to its shard; a neighbour whose highest-weight id
belongs to another shard is not found. Memory is bounded by one block and the longest text;
only one number for each id of the vocabulary reaches the driver. Defined
results: a null text is empty and holds its end id alone; repeated rows are documents of
their own; ties in the ranking go to the earlier row; an empty table gives no piece.
``sequence_id`` is unique, and the same when a task is run again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.text import slices, turn_to
from innsight.llm.tables import stored, stored_at
from innsight.llm.tokens import closed, crc, default_path, encoder
from innsight.sources.storage import remove, scratch_path

WINDOW, BLOCK_TOKENS = 2048, 1_000_000
K1, B = 1.2, 0.75
SCHEMA = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


@dataclass
class Corpus:
    """What BM25 knows of all documents."""

    documents: int
    mean: float
    held: np.ndarray  # documents that hold each id

    def idf(self, df: np.ndarray) -> np.ndarray:
        return np.log1p((self.documents - df + 0.5) / (df + 0.5))


class Shard:
    """Inverted index of one block: for each id the documents that hold it, with BM25 weights by the corpus or else by the block."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus | None = None):
        held = [np.unique(d, return_counts=True) for d in docs]
        sizes, self.ends = np.array([len(d) for d in docs], float), np.cumsum([0, *(len(h[0]) for h in held)])
        term = np.concatenate([h[0] for h in held])
        owner = np.repeat(np.arange(len(docs)), np.diff(self.ends))
        tf = np.concatenate([h[1] for h in held]).astype(float)
        order = np.argsort(term, kind="stable")
        self.owner = owner[order]
        self.vocabulary, self.begin, df = np.unique(term[order], return_index=True, return_counts=True)
        self.size = df
        self.number = np.empty(len(term), np.int64)  # of each document's terms in the vocabulary
        self.number[order] = np.repeat(np.arange(len(df)), df)
        corpus = corpus or Corpus(len(docs), sizes.mean(), np.bincount(self.vocabulary, df))
        idf = corpus.idf(corpus.held[self.vocabulary])
        norm = K1 * (1 - B + B * sizes / corpus.mean)
        tf = tf[order]
        self.weight = np.repeat(idf, df) * tf * (K1 + 1) / (tf + norm[self.owner])

    def like(self, doc: int) -> np.ndarray:
        """Score of every document for the terms of one of them."""
        return self._scores(self.number[self.ends[doc] : self.ends[doc + 1]])

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Score of every document for any ids."""
        terms = np.unique(ids)
        at = np.minimum(np.searchsorted(self.vocabulary, terms), len(self.vocabulary) - 1)
        return self._scores(at[self.vocabulary[at] == terms])

    def _scores(self, at: np.ndarray) -> np.ndarray:
        size, n = self.size[at], int(self.size[at].sum())
        place = np.repeat(self.begin[at] - np.cumsum(size) + size, size) + np.arange(n)
        return np.bincount(self.owner[place], self.weight[place], minlength=len(self.ends) - 1)


class Packer:
    """Windows of one task. A piece is (document, its ids, begin, end)."""

    def __init__(self, window: int, first: int, corpus: Corpus | None = None):
        self.window, self.sequence, self.corpus = window, first, corpus
        self.open: list[tuple] = []  # of the window being filled
        self.filled = 0
        self.rows: list[tuple] = []

    def _close(self) -> None:
        offset = 0
        for (doc_id, ids), a, b in self.open:
            self.rows.append((doc_id, a, b - a, crc(ids[a:b]), len(ids), self.sequence, offset))
            offset += b - a
        self.sequence, self.open, self.filled = self.sequence + 1, [], 0

    def add(self, doc: tuple, at: int = 0) -> bool:
        """Place a document from ``at`` on, cut at window ends; whether a window was closed."""
        closed_one = False
        while at < len(doc[1]):
            end = min(len(doc[1]), at + self.window - self.filled)
            self.open.append((doc, at, end))
            self.filled += end - at
            at = end
            if self.filled == self.window:
                self._close()
                closed_one = True
        return closed_one

    def block(self, docs: list[tuple]) -> None:
        """Pack a block; the window that is not full stays open."""
        if not docs:
            return
        shard, used, next_one = Shard([d[1] for d in docs], self.corpus), np.zeros(len(docs), bool), 0
        # Scores of the window's seed; the first may come from the block before.
        scores = shard.scores(self.open[-1][0][1]) if self.open else None
        for _ in docs:
            pick = int(scores.argmax()) if scores is not None else -1
            if pick < 0 or scores[pick] <= 0:
                while used[next_one]:
                    next_one += 1
                pick = next_one
            used[pick] = True
            if scores is not None:
                scores[pick] = -1.0
            fresh = not self.open
            if self.add(docs[pick]) or fresh:
                # The rest of the cut document, or the document that opened a window, is the seed.
                scores = shard.like(pick) if self.open else None
                if scores is not None:
                    scores[used] = -1.0

    def finish(self) -> None:
        pieces, left = self.open, self.filled
        self.open, self.filled = [], 0
        at = 0
        while left:
            take = 1 << (left.bit_length() - 1)
            left -= take
            while take:
                doc, a, b = pieces[at]
                end = min(b, a + take)
                self.open.append((doc, a, end))
                take -= end - a
                pieces[at] = (doc, end, b)
                at += end == b
            self._close()


def _packed(ids: np.ndarray) -> bytes:
    """Ids in two bytes each where all of them fit, else four; the last byte tells which."""
    return ids.astype("<u2").tobytes() + b"\2" if ids.max(initial=0) < 1 << 16 else ids.astype("<u4").tobytes() + b"\4"


def _unpacked(raw: bytes) -> np.ndarray:
    width = raw[-1]
    return np.frombuffer(raw, f"<u{width}", count=(len(raw) - 1) // width).astype("<u4")


def _encoded(path: str):
    """(doc_id, ids) of each document and, last in each task, what the task counted for BM25.

    Counts: documents, ids, and from then on the documents that hold each id.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, total = np.zeros(1 << 10, np.int64), 0, 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([len(t or "") for t in texts], 2_000_000):
                tokens = [closed(t) for t in encoder(path).encode(texts[a:b])]
                for x in tokens:
                    own = np.unique(x)
                    if own[-1] >= len(held):
                        held = np.pad(held, (0, 2 * int(own[-1]) - len(held)))
                    held[own] += 1
                documents, total = documents + len(tokens), total + sum(map(len, tokens))
                yield pa.RecordBatch.from_arrays([pa.array(ids[a:b], pa.int64()), pa.array(map(_packed, tokens), pa.binary()), pa.nulls(b - a, pa.binary())], schema=schema)
        counts = np.concatenate([[documents, total], held]).astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts], pa.binary())], schema=schema)

    return run


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that hold each id; at -1 all documents, at -2 all ids."""
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            counts = np.frombuffer(raw, "<i8")
            at = np.flatnonzero(counts[2:])
            yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *at.tolist()], pa.int64()), pa.array([*counts[:2].tolist(), *counts[2:][at].tolist()], pa.int64())], names=["id", "n"])


def top_id(ids: np.ndarray, corpus: Corpus) -> int:
    """The id of highest BM25 weight in a document, among those that another document holds; else the rarest."""
    terms, tf = np.unique(ids, return_counts=True)
    held = corpus.held[terms]
    weight = corpus.idf(held) * tf / (tf + K1 * (1 - B + B * len(ids) / corpus.mean))
    weight[held < 2] -= weight.max() + 1
    return int(terms[weight.argmax()])


def _topped(corpus: Corpus):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn_to("packing")
        for batch in batches:
            arrays = [_unpacked(raw) for raw in batch.column(1).to_pylist()]
            top, size = [top_id(x, corpus) for x in arrays], [len(x) for x in arrays]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(top, pa.int64()), pa.array(size, pa.int64())], names=["doc_id", "ids", "top", "size"])

    return run


def shards(tops: np.ndarray, sizes: np.ndarray, block_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """First shard of each top id and the number of shards it is split into."""
    begin, split = np.zeros(int(tops.max(initial=-1)) + 1, np.int64), np.ones(int(tops.max(initial=-1)) + 1, np.int64)
    number = held = 0
    for top, size in zip(tops.tolist(), sizes.tolist()):
        if size > block_tokens:
            number, held = number + bool(held), 0
            begin[top], split[top] = number, -(-size // block_tokens)
            number += int(split[top])
            continue
        if held and held + size > block_tokens:
            number, held = number + 1, 0
        begin[top], held = number, held + size
    return begin, split


def _pack(window: int, block_tokens: int, corpus: Corpus):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn_to("packing")
        packer, docs, held, shard = Packer(window, TaskContext.get().partitionId() << 36, corpus), [], 0, None

        def out() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * len(SCHEMA), schema=SCHEMA)

        for batch in batches:
            for doc_id, raw, own in zip(*(c.to_pylist() for c in batch.columns)):
                if own != shard or held >= block_tokens:
                    packer.block(docs)
                    docs, held, shard = [], 0, own
                docs.append((doc_id, _unpacked(raw)))
                held += len(docs[-1][1])
            yield out()
        packer.block(docs)
        packer.finish()
        yield out()

    return run


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, window: int = WINDOW, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row for each piece of each document; other columns are not read."""
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    folder = scratch_path(spark, "packing-ids")
    encoded = stored_at(own.mapInArrow(_encoded(path or default_path()), "doc_id long, ids binary, counts binary"), folder)
    counts = encoded.where("counts IS NOT NULL").select("counts").mapInArrow(_frequencies, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()  # one row for each id
    counts = dict(zip(counts["id"].tolist(), counts["n"].tolist()))
    documents, total = counts.pop(-1, 0), counts.pop(-2, 0)
    held = np.zeros(max(counts, default=0) + 1, np.int64)
    held[list(counts)] = list(counts.values())
    corpus = Corpus(documents, total / max(1, documents), held)
    topped = stored(encoded.where("ids IS NOT NULL").select("doc_id", "ids").mapInArrow(_topped(corpus), "doc_id long, ids binary, top long, size long"), "packing-tops")
    remove(spark, folder)
    sizes = topped.groupBy("top").agg(F.sum("size").alias("size")).orderBy("top").toPandas()
    begin, split = shards(sizes["top"].to_numpy(np.int64), sizes["size"].to_numpy(np.int64), block_tokens)

    def shard(top: pd.Series, salt: pd.Series) -> pd.Series:
        return pd.Series(begin[top] + salt.to_numpy() % split[top])

    shard.__annotations__ = {"top": pd.Series, "salt": pd.Series, "return": pd.Series}
    shard = F.pandas_udf(shard, "long")
    dealt = topped.withColumn("shard", shard("top", F.xxhash64("doc_id", "ids"))).select("doc_id", "ids", "shard")
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard").sortWithinPartitions("shard", "doc_id", "ids")
    return dealt.mapInArrow(_pack(window, block_tokens, corpus), ", ".join(f"{c} long" for c in SCHEMA.names))
