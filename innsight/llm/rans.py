"""Token files coded by a static range asymmetric numeral system.

``write_tokens`` encodes every whole text, counts the ids of all documents into one shared
frequency table, orders the documents by id over range partitions, and writes blocks of
about ``block_tokens`` ids. A block holds whole documents, is coded alone by interleaved
lanes (id i belongs to lane i mod lanes), and carries checkpoints of all lane states, so
several tasks can decode one block from different places, and checksums of its bytes and
of its ids. Blocks are rows of a Parquet dataset, because Spark's committer makes a write
whole when executors are lost and any store that Spark reads will do; ``block`` is the
self-contained byte string, with its own header.

``read_tokens`` gives one row for each document from these files alone.

Block, all little-endian: header (``HEADER``), document ids (8 bytes, with a byte each for
"known"), their lengths (8 bytes), checkpoints (word position, then one 8-byte state for
each lane), the final states, 4-byte words. The table is a row of its own dataset.

Defined results: a null text is empty and holds its end id alone; documents without an id
come first; documents that share an id are ordered by their ids' checksum, equal ones
stand next to each other; an empty table makes an empty dataset.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innsight.llm.text import slices
from innsight.llm.tokens import closed, crc, default_path, encoder
from innsight.llm.tables import stored_at
from innsight.sources.storage import remove, scratch_path

BITS, LANES, EVERY, BLOCK_TOKENS = 20, 2048, 256, 1_000_000
LOW = np.uint64(1 << 31)
MAGIC = b"RNS1"
HEADER = np.dtype([("magic", "S4"), ("lanes", "<u4"), ("bits", "<u4"), ("every", "<u4"), ("docs", "<u8"), ("tokens", "<u8"), ("words", "<u8"), ("checkpoints", "<u8"), ("ids_crc32", "<u4"), ("rest_crc32", "<u4")])


class Table:
    """Frequencies that sum to 2**bits; every id that was counted has at least one."""

    def __init__(self, counts: np.ndarray, bits: int = BITS):
        total, counts = 1 << bits, np.asarray(counts, np.int64)
        freq = np.zeros(len(counts), np.int64)
        have = counts > 0
        if have.sum() > total:
            raise ValueError("more different ids than the table can tell apart")
        if have.any():
            freq[have] = np.maximum(1, (counts[have].astype(float) * (total / counts.sum())).astype(np.int64))
            over = int(freq.sum()) - total
            order = np.argsort(-freq, kind="stable")
            while over:  # rounding, settled by the most frequent ids
                for k in order:
                    step = max(-(1 << 30), min(over, int(freq[k]) - 1, max(1, int(freq[k]) // 8))) if over > 0 else over
                    freq[k] -= step
                    over -= step
                    if not over:
                        break
        self.bits, self.freq = bits, freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64) if len(freq) else self.freq
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def encode(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = EVERY) -> tuple[np.ndarray, list[tuple[int, np.ndarray]], np.ndarray]:
    """(final states, checkpoints, words). A checkpoint every ``every`` steps: words read so far, states."""
    freq, start, bits = table.freq[ids], table.start[ids], np.uint64(table.bits)
    most = freq << (np.uint64(63) - bits)
    state, steps = np.full(lanes, LOW), -(-len(ids) // lanes)
    out: list[np.ndarray] = []
    written, marks = 0, []
    for s in range(steps - 1, -1, -1):
        a, b = s * lanes, min(len(ids), (s + 1) * lanes)
        x, f = state[: b - a], freq[a:b]
        full = x >= most[a:b]
        if full.any():
            out.append(x[full].astype(np.uint32))  # its low half
            written += len(out[-1])
            x[full] >>= np.uint64(32)
        q, r = np.divmod(x, f)
        state[: b - a] = (q << bits) + r + start[a:b]
        if s and s % every == 0:
            marks.append((written, state.copy()))
    words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    return state, [(written - w, x) for w, x in reversed(marks)], words


def decode(n: int, table: Table, state: np.ndarray, words: np.ndarray, lanes: int = LANES, first_step: int = 0, at: int = 0, last_step: int | None = None) -> np.ndarray:
    """The ids of the steps from ``first_step`` on, given the states and word position there."""
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    state, steps = state.copy(), -(-n // lanes)
    last_step = steps if last_step is None else min(steps, last_step)
    out = np.empty(max(0, min(n, last_step * lanes) - first_step * lanes), np.uint32)
    wide = words.astype(np.uint64)
    for s in range(first_step, last_step):
        a, b = s * lanes, min(n, (s + 1) * lanes)
        x = state[: b - a]
        slot = x & mask
        symbol = table.symbol[slot]
        x = table.freq[symbol] * (x >> bits) + slot - table.start[symbol]
        low = x < LOW
        k = int(np.count_nonzero(low))
        if k:
            x[low] = (x[low] << np.uint64(32)) | wide[at : at + k]
            at += k
        state[: b - a] = x
        out[a - first_step * lanes : b - first_step * lanes] = symbol
    return out


def to_block(docs: list[tuple[int | None, np.ndarray]], table: Table, lanes: int = LANES, every: int = EVERY) -> bytes:
    ids = np.concatenate([d[1] for d in docs])
    state, marks, words = encode(ids, table, lanes, every)
    rest = b"".join([
        np.array([d[0] or 0 for d in docs], "<i8").tobytes(), np.array([d[0] is not None for d in docs], "u1").tobytes(),
        np.array([len(d[1]) for d in docs], "<u8").tobytes(), *(np.array([at], "<u8").tobytes() + x.astype("<u8").tobytes() for at, x in marks),
        state.astype("<u8").tobytes(), words.astype("<u4").tobytes(),
    ])
    head = np.array([(MAGIC, lanes, table.bits, every, len(docs), len(ids), len(words), len(marks), crc(ids), zlib.crc32(rest))], HEADER)
    return head.tobytes() + rest


class Block:
    """A parsed block; raises ValueError where a checksum does not fit."""

    def __init__(self, data: bytes):
        self.head = np.frombuffer(data, HEADER, 1)[0]
        at, h = HEADER.itemsize, self.head
        if h["magic"] != MAGIC or zlib.crc32(data[at:]) != h["rest_crc32"]:
            raise ValueError("damaged block")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        docs, lanes = int(h["docs"]), int(h["lanes"])
        ids, known = take("<i8", docs), take("u1", docs)
        self.doc_ids, self.lengths = [int(i) if k else None for i, k in zip(ids, known)], take("<u8", docs).astype(np.int64)
        marks = [(int(take("<u8", 1)[0]), take("<u8", lanes)) for _ in range(int(h["checkpoints"]))]
        self.places = [(0, 0, take("<u8", lanes)), *((int(h["every"]) * (k + 1), w, x) for k, (w, x) in enumerate(marks))]
        self.words = take("<u4", int(h["words"]))

    def part(self, table: Table, k: int) -> np.ndarray:
        """The ids between checkpoint ``k`` and the next."""
        step, at, state = self.places[k]
        last = self.places[k + 1][0] if k + 1 < len(self.places) else None
        return decode(int(self.head["tokens"]), table, state, self.words, int(self.head["lanes"]), step, at, last)

    def ids(self, table: Table) -> np.ndarray:
        out = np.concatenate([self.part(table, k) for k in range(len(self.places))])
        if crc(out) != self.head["ids_crc32"]:
            raise ValueError("decoded ids do not fit their checksum")
        return out


def _encoded(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slices([len(t or "") for t in texts], 2_000_000):
                found = [closed(x) for x in encoder(path).encode(texts[a:b])]
                # Ids of a small vocabulary are kept in two bytes.
                packed = [x.astype("<u2").tobytes() if x.max() < 65536 else b"+" + x.tobytes() for x in found]
                yield pa.RecordBatch.from_arrays([keys.slice(a, b - a).cast(pa.int64()), pa.array([crc(x) for x in found], pa.int64()), pa.array(packed, pa.binary())], schema=schema)

    return run, "doc_id long, ids_crc32 long, ids binary"


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4", offset=1) if len(data) % 2 else np.frombuffer(data, "<u2").astype("<u4")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        ids = [_unpacked(x) for x in batch.column(0).to_pylist()]
        own = np.bincount(np.concatenate(ids)) if ids else total[:0]
        if len(own) > len(total):
            total = np.pad(total, (0, len(own) - len(total)))
        total[: len(own)] += own
    have = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": pa.array(have, pa.int64()), "n": pa.array(total[have], pa.int64())})


def _blocks(table: Table, block_tokens: int):
    schema = pa.schema([("shard", pa.int64()), ("number", pa.int64()), ("tokens", pa.int64()), ("block", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, number, docs, held = TaskContext.get().partitionId(), 0, [], 0

        def out() -> pa.RecordBatch:
            row = (shard, number, held, to_block(docs, table))
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for key, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = _unpacked(data.as_py())
                if docs and held + len(ids) > block_tokens:
                    yield out()
                    number, docs, held = number + 1, [], 0
                docs.append((key, ids))
                held += len(ids)
        if docs:
            yield out()

    return run, "shard long, number long, tokens long, block binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the blocks to ``path``/blocks and the shared table to ``path``/table."""
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    run, schema = _encoded(tokenizer or default_path())
    at = scratch_path(spark, "rans-ids")
    ids = stored_at(own.mapInArrow(run, schema), at)
    # One row for each id of the vocabulary at most.
    counted = ids.select("ids").mapInArrow(_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counted.write.mode("overwrite").parquet(f"{path}/table")
    run, schema = _blocks(read_table(spark, path), block_tokens)
    ordered = ids.repartitionByRange("doc_id", "ids_crc32").sortWithinPartitions("doc_id", "ids_crc32")
    ordered.select("doc_id", "ids").mapInArrow(run, schema).write.mode("overwrite").parquet(f"{path}/blocks")
    remove(spark, at)


def read_table(spark: SparkSession, path: str) -> Table:
    rows = spark.read.schema("id long, n long").parquet(f"{path}/table").toPandas()
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 0, np.int64)
    counts[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return Table(counts)


def _documents(table: Table):
    schema = pa.schema([(c, pa.int64()) for c in ("shard", "number", "doc_id", "before", "n_tokens", "ids_crc32")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, data in zip(*(batch.column(k).to_pylist() for k in range(2)), batch.column(2)):
                block = Block(data.as_py())
                ids, ends = block.ids(table), np.cumsum(block.lengths)
                sums = [crc(ids[e - n : e]) for e, n in zip(ends, block.lengths)]
                n = len(sums)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in ([shard] * n, [number] * n, block.doc_ids, ends - block.lengths, block.lengths, sums)], schema=schema)

    return run, "shard long, number long, doc_id long, before long, n_tokens long, ids_crc32 long"


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files, start counted over all files."""
    blocks = spark.read.schema("shard long, number long, tokens long, block binary").parquet(f"{path}/blocks")
    sizes = blocks.select("shard", "number", "tokens")
    before = Window.partitionBy("shard").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.select("shard", "number", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("inside"))
    # One row for each write task.
    shards = sizes.groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("earlier"))
    begins = inside.join(shards, "shard").select("shard", "number", (F.col("inside") + F.col("earlier")).alias("begin"))
    run, schema = _documents(read_table(spark, path))
    docs = blocks.select("shard", "number", "block").mapInArrow(run, schema)
    return docs.join(begins, ["shard", "number"]).select("doc_id", (F.col("begin") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` below the shared folder and give the rows read back from there."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_tokens(docs.sparkSession, path)
