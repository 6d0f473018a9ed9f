"""Jaccard join of word n-gram sets on a prefix tree.

1. Every whole text becomes its set of 64-bit shingle hashes. Equal sets fall together by
   a 128-bit fingerprint.
2. A count filter finds the sets that can have a partner. A linked set misses at most a
   quarter of its shingles, so a set with more than that many shingles found nowhere else,
   counted over the lower half of the hash range, has none. Each chunk of texts first
   merges its own hashes, so a passage found in a third of all texts is sent once per chunk.
   The sets left are counted once more, over the whole range.
3. Shingles of the remaining sets that occur in exactly the same sets are one weighted
   class. Classes are ordered by how many sets hold them, the rarest first.
4. Two linked sets share a class in the leading part of both orders. Sets meet by such a
   class; a large meeting is cut into parts, and every pair of parts is one block.
5. A block keeps its sets in a trie whose edges are runs of classes without a branch. All
   sets of the block search it together: they walk it along the shared order, add up the
   common weight, and a set leaves a subtree when the weight that can still be added is too
   little, or when the subtree is already connected to it.
6. The links of all blocks give the components.

All pairs within a group are never written out: a block returns a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.components import components
from innsight.llm.text import WORD, ascii_lower, rolling, scrambled, slices, turn_to
from innsight.llm.tables import stored, stored_at
from innsight.sources.storage import remove, scratch_path

WORDS, PERCENT = 5, 75
BLOCK = 512  # sets of a part
MOST_DENSE = 4_000_000  # entries of a block's classes by sets as a matrix, 32 MB
MOST_BROADCAST = 500_000  # rows of an id and a fingerprint, about 30 MB, or of a number; more are joined by a shuffle
_HALF = np.uint64(1 << 63)
_COMMON = 0xFFFF  # stands for a hash that several texts of one chunk hold
_META = np.dtype([("doc_id", "<i8"), ("known", "?"), ("n", "<i8"), ("set_id", "V16")])


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; of the whole sequence if it is shorter."""
    found = WORD.findall(ascii_lower(text)) if text else []
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    return np.unique(rolling(codes, min(n, len(codes)))) if len(codes) else codes


def set_id(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


_CHUNK = pa.schema([("chunk", pa.string()), ("bucket", pa.int32()), ("docs", pa.binary()), ("keys", pa.binary()), ("owners", pa.binary())])
_CHUNK_DDL = "chunk string, bucket int, docs binary, keys binary, owners binary"


def _chunk(name: str, docs: np.ndarray, hashes: list[np.ndarray], buckets: int, bits: int) -> pa.RecordBatch:
    """Rows of one chunk: its documents (bucket -1), and its hashes, all of at most ``bits`` bits, dealt by range."""
    keys = np.concatenate(hashes)
    owners = np.repeat(np.arange(len(hashes), dtype=np.uint16), [len(h) for h in hashes])
    order = np.argsort(keys, kind="stable")
    keys, owners = keys[order], owners[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    alone = first.copy()
    alone[:-1] &= first[1:]
    owners = np.where(alone, owners, _COMMON)[first].astype("<u2")
    keys = keys[first]
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(bits - 32)
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    short = keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    rows = [(name, -1, docs.tobytes(), b"", b"")]
    rows += [(name, k, b"", short[x:y].tobytes(), owners[x:y].tobytes()) for k, (x, y) in enumerate(zip(edges, edges[1:])) if x < y]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _CHUNK)], schema=_CHUNK)


def _chunks(n_words: int, buckets: int, chunk_chars: int):
    """Texts to chunks with the lower half of their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn_to("jaccard")
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([len(t or "") for t in texts], chunk_chars):
                sets = [shingles(t, n_words) for t in texts[a:b]]
                docs = np.array([(i or 0, i is not None, len(s), set_id(s)) for i, s in zip(ids[a:b], sets)], _META)
                name, number = f"{part}-{number}", number + 1
                yield _chunk(name, docs, [s[: np.searchsorted(s, _HALF)] for s in sets], buckets, 63)

    return run, _CHUNK_DDL


def _whole_chunks(buckets: int, chunk_hashes: int):
    """Sets to chunks with all of their hashes; the number of a set stands for its document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            numbers, sizes, lists = batch.column("s").to_pylist(), batch.column("n").to_pylist(), batch.column("hashes")
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            for a, b in slices(sizes, chunk_hashes):
                docs = np.array([(s, True, n, bytes(16)) for s, n in zip(numbers[a:b], sizes[a:b])], _META)
                name, number = f"{part}-{number}", number + 1
                yield _chunk(name, docs, [flat[x:y] for x, y in zip(at[a:b], at[a + 1 : b + 1])], buckets, 64)

    return run, _CHUNK_DDL


def _lonely(bucket: pd.DataFrame) -> pd.DataFrame:
    """For each chunk of one hash range: how many of each document's hashes no other text holds.

    Keys are cut to 48 bits; two that fall together only make a hash look shared.
    """
    sizes = bucket["keys"].map(len).to_numpy() // 6
    packed = np.frombuffer(b"".join(bucket["keys"]), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(packed), 8), np.uint8)
    wide[:, :6] = packed
    keys, owners = wide.view("<u8").ravel(), np.frombuffer(b"".join(bucket["owners"]), "<u2")
    order = np.argsort(keys)
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = keys[order][1:] != keys[order][:-1]
    alone = np.zeros(len(keys), bool)
    alone[order] = new[:-1] & new[1:]
    alone &= owners != _COMMON
    ends = np.cumsum(sizes)
    counts = [np.bincount(owners[e - n : e][alone[e - n : e]]) for e, n in zip(ends, sizes)]
    return pd.DataFrame({"chunk": bucket["chunk"].to_numpy(), "lonely": [np.minimum(c, 0xFFFF).astype("<u2").tobytes() for c in counts]})


def _marks(percent: int):
    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        """Documents of one chunk, and whether each may have a partner."""
        docs = np.frombuffer(chunk["docs"][chunk["docs"].map(len) > 0].iloc[0], _META)
        lonely = np.zeros(len(docs), np.int64)
        for part in chunk["lonely"]:
            counts = np.frombuffer(part, "<u2")
            lonely[: len(counts)] += counts
        return pd.DataFrame({
            "doc_id": pd.arrays.IntegerArray(docs["doc_id"].copy(), ~docs["known"]),
            "n": docs["n"], "set_id": [bytes(x) for x in docs["set_id"]], "suspect": 100 * lonely <= (100 - percent) * docs["n"],
        })

    return run


def _marked(chunks: DataFrame, percent: int) -> DataFrame:
    """Documents of written chunks, with those marked that may have a partner."""
    lonely = chunks.where("bucket >= 0").groupBy("bucket").applyInPandas(_lonely, "chunk string, lonely binary")
    both = chunks.where("bucket < 0").select("chunk", "docs", F.lit(b"").alias("lonely")).union(lonely.select("chunk", F.lit(b"").alias("docs"), "lonely"))
    return both.groupBy("chunk").applyInPandas(_marks(percent), "doc_id long, n long, set_id binary, suspect boolean")


def _sets(n_words: int):
    schema = pa.schema([("set_id", pa.binary()), ("n", pa.int64()), ("hashes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, wanted = batch.column("text").to_pylist(), batch.column("set_id").to_pylist()
            for a, b in slices([len(t or "") for t in texts], 4_000_000):
                sets = [(w, s) for w, t in zip(wanted[a:b], texts[a:b]) if set_id(s := shingles(t, n_words)) == w]
                values = [pa.array([x[0] for x in sets], pa.binary()), pa.array([len(x[1]) for x in sets], pa.int64())]
                ends = np.cumsum([0, *(len(x[1]) for x in sets)]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.uint64), *(x[1] for x in sets)]).view(np.int64)
                values.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(values, schema=schema)

    return run, "set_id binary, n long, hashes array<long>"


def _leading(percent: int):
    """One row for each class in the leading part of a set, where it may meet a partner first."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = []
            for n, weights in zip(frame["n"], frame["weights"]):
                rest = np.cumsum(weights[::-1])[::-1]
                counts.append(int((100 * rest >= percent * n).sum()))
            keys = [k[:c] for k, c in zip(frame["keys"], counts)]
            yield pd.DataFrame({"key": np.concatenate([np.zeros(0, np.int64), *keys]), "set_id": np.repeat(frame["set_id"].to_numpy(object), counts)})

    return run, "key long, set_id binary"


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places ``starts[k]`` to ``starts[k] + counts[k]`` of every k, one after the other."""
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())


def linked(sizes: np.ndarray, owners: np.ndarray, ranks: np.ndarray, weight: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """For each set of one block a member of its component, the same for all of them.

    ``owners`` and ``ranks`` tell which set holds which class, in the order of the sets and then of
    the classes; ``weight`` is that of each class. In the order of their class lists the sets below a
    node of the trie are neighbours, so a node is a range of them. A run of classes without a branch
    is one edge, and all sets that still search a subtree go down an edge together.
    """
    m, whole = len(sizes), 100 + percent
    ends = np.searchsorted(owners, np.arange(m + 1))
    big = ranks.astype(">u4")
    lists = [big[a:b].tobytes() for a, b in zip(ends, ends[1:])]
    order = np.array(sorted(range(m), key=lists.__getitem__), np.int64)
    place = np.empty(m, np.int64)
    place[order] = np.arange(m)
    starts, lengths, size = ends[:-1][order], np.diff(ends)[order], sizes[order]
    lcp = np.zeros(m + 1, np.int64)  # classes that a set shares at the start with the one before
    for p in range(1, m):
        n = min(lengths[p], lengths[p - 1])
        other = ranks[starts[p] : starts[p] + n] != ranks[starts[p - 1] : starts[p - 1] + n]
        lcp[p] = other.argmax() if other.any() else n
    # Holders of each class, and the weight before each entry of a list.
    by_class = np.argsort(ranks, kind="stable")
    holder, held = place[owners[by_class]], weight[ranks[by_class]]
    first = np.searchsorted(ranks[by_class], np.arange(len(weight) + 1))
    count = np.diff(first)
    dense = None  # weight of each class in each set, where most sets hold most classes
    if m * len(weight) <= min(4 * len(ranks), MOST_DENSE):
        dense = np.zeros((len(weight), m))
        dense[ranks[by_class], holder] = held
    before = np.append(0, np.cumsum(weight[ranks]))
    total = before[starts + lengths] - before[starts]
    codes, base = owners * len(weight) + ranks, order * len(weight)
    group = np.arange(m)
    todo = [(0, m, 0, np.arange(m), np.zeros(m, np.int64))]
    while todo:
        a, b, depth, searching, common = todo.pop()
        edges = [a, *(a + 1 + np.flatnonzero(lcp[a + 1 : b] == depth)).tolist(), b]
        for s, t in zip(edges, edges[1:]):
            if lengths[s] == depth:  # ends here
                hits = np.searchsorted(searching, s, "right")
                near = searching[hits:][whole * common[hits:] >= percent * (size[s] + size[searching[hits:]])]
                if len(near):
                    met = np.zeros(m, bool)
                    met[group[near]] = met[group[s]] = True
                    group[met[group]] = met.argmax()
                continue
            later = np.searchsorted(searching, s, "right")  # a pair is found by the later of its sets
            who, got = searching[later:], common[later:]
            below = group[s:t]
            if (below == below[0]).all():
                apart = group[who] != below[0]
                who, got = who[apart], got[apart]
            if not len(who):
                continue
            deep = int(lcp[s + 1 : t].min()) if t - s > 1 else int(lengths[s])
            run = ranks[starts[s] + depth : starts[s] + deep]
            if dense is None:
                entries = _spread(first[run], count[run])
                more = np.bincount(holder[entries], held[entries], m)
            else:
                walked = np.zeros(run[-1] + 1 - run[0])
                walked[run - run[0]] = 1
                more = walked @ dense[run[0] : run[-1] + 1]
            got = got + more.astype(np.int64)[who]
            at = np.searchsorted(codes, base[who] + run[-1], "right")
            own_rest = before[starts[who] + lengths[who]] - before[at]
            rest = total[s:t].max() - (before[starts[s] + deep] - before[starts[s]])
            able = whole * (got + np.minimum(own_rest, rest)) >= percent * (size[s:t].min() + size[who])
            if able.any():
                todo.append((s, t, deep, who[able], got[able]))
    return order[group[place]]


def _block(key: int, sizes: np.ndarray, owners: np.ndarray, keys: np.ndarray, weights: np.ndarray, percent: int) -> list[int]:
    """A member of the component of each set of one block; ``owners``, ``keys``, ``weights``: all their classes.

    Classes that the same sets of the block hold are one here, the rarest first, and a
    class that one set holds alone adds to no overlap.
    """
    own = keys >= key  # what comes before is met elsewhere
    owners, keys, weights = owners[own], keys[own], weights[own].astype(np.int64)
    alive = np.ones(len(sizes), bool)
    while True:  # sets that fall out leave classes alone that others counted on
        order = np.argsort(keys, kind="stable")
        owners, keys, weights = owners[order], keys[order], weights[order]
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        count = np.diff(first, append=len(keys))
        shared = np.repeat(count > 1, count)
        total = np.bincount(owners[shared], weights[shared], len(sizes))
        able = alive & (100 * total >= percent * sizes)
        if able.sum() < 2:
            return list(range(len(sizes)))
        stays = shared & able[owners]
        done, alive = bool((able == alive).all()), able
        owners, keys, weights = owners[stays], keys[stays], weights[stays]
        if done:
            break
    viable = np.flatnonzero(alive)
    roots = np.arange(len(sizes))
    if len(viable) == 2:  # what they share is all that is left
        a, b = viable
        roots[b] = a if (100 + percent) * total[a] >= percent * (sizes[a] + sizes[b]) else b
        return roots.tolist()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    count = np.diff(first, append=len(keys))
    marks = scrambled(np.arange(1, len(sizes) + 1, dtype=np.uint64))
    holders = np.bitwise_xor.reduceat(marks[owners], first)
    _, one, place = np.unique(holders, return_index=True, return_inverse=True)
    weight = np.bincount(place, weights[first]).astype(np.int64)
    ranked = np.argsort(count[one], kind="stable")
    one, weight = one[ranked], weight[ranked]
    ranks, owners = np.repeat(np.arange(len(one)), count[one]), owners[_spread(first[one], count[one])]
    owners = np.searchsorted(viable, owners)
    order = np.lexsort((ranks, owners))
    roots[viable] = viable[linked(sizes[viable], owners[order], ranks[order], weight, percent)]
    return roots.tolist()


def _links(percent: int):
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def spanned(table: pa.RecordBatch, edges: list[int]) -> pa.RecordBatch:
        ids, sizes, key = table.column("set_id").to_pylist(), table.column("n").to_numpy(), table.column("key").to_numpy()
        keys, weights = table.column("keys"), table.column("weights")
        at, keys, weights = keys.offsets.to_numpy(), keys.values.to_numpy(), weights.values.to_numpy()
        rows = []
        for a, b in zip(edges, edges[1:]):
            # A set that comes with both parts of a block is one set here.
            own = sorted({s: k for k, s in zip(range(b - 1, a - 1, -1), ids[a:b][::-1])}.values(), key=lambda k: ids[k])
            if len(own) > 1:
                lengths = at[np.array(own) + 1] - at[own]
                flat = np.concatenate([np.arange(at[k], at[k + 1]) for k in own])
                roots = _block(int(key[a]), sizes[own], np.repeat(np.arange(len(own)), lengths), keys[flat], weights[flat], percent)
                rows += [(ids[own[x]], ids[own[r]]) for x, r in enumerate(roots) if x != r]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of the blocks of one task; rows come sorted by block, and a block has at most two parts."""
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            held = table.to_batches()[0] if len(table) else None
            if held is None:
                continue
            heads = np.stack([held.column(c).to_numpy() for c in ("key", "i", "j")])
            edges = [0, *(np.flatnonzero((heads[:, 1:] != heads[:, :-1]).any(0)) + 1).tolist()]
            yield spanned(held, edges)
            held = pa.Table.from_batches([held.slice(edges[-1])]).take(pa.array(range(len(held) - edges[-1]))).combine_chunks().to_batches()[0]
        if held is not None:
            yield spanned(held, [0, len(held)])

    return run


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_words: int = WORDS, percent: int = PERCENT,
    block: int = BLOCK, chunk_chars: int = 4_000_000,
) -> DataFrame:
    """(doc_id, n_shingles, component_id): one row for each row of ``docs``.

    Two documents link when ``100 * |intersection| >= percent * |union|`` of their distinct
    word n-gram sets; ``component_id`` is the smallest id reachable by links. A null, empty or
    wordless text has the empty set and only itself as component. Repeated rows link like any
    equal texts. A row without an id keeps a null component and links nothing. Other columns
    are not read. Hashes are 64 bits wide, fingerprints 128.
    """
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    run, schema = _chunks(n_words, buckets, chunk_chars)
    at = scratch_path(spark, "jaccard-chunks")
    chunks = stored_at(own.mapInArrow(run, schema), at)
    marks = stored(_marked(chunks, percent), "jaccard-marks")
    remove(spark, at)  # the largest table here, and read for the last time

    groups = marks.where("n > 0 AND doc_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("first"), F.max("suspect").alias("suspect"))
    groups = stored(groups, "jaccard-groups")
    wanted = groups.where("suspect").select(F.col("first").alias("doc_id"), "set_id")
    # Few sets are left as a rule; then the texts need not be shuffled to find theirs.
    if wanted.count() <= MOST_BROADCAST:
        wanted = F.broadcast(wanted)
    run, schema = _sets(n_words)
    used: list[str] = []  # tables to delete once what is built from them is written

    def kept(df: DataFrame, label: str) -> DataFrame:
        used.append(scratch_path(spark, label))
        return stored_at(df, used[-1])

    def drop() -> None:
        while used:
            remove(spark, used.pop())

    sets = own.join(wanted, "doc_id").select("set_id", "text").mapInArrow(run, schema).dropDuplicates(["set_id"])
    sets = kept(sets.withColumn("s", F.monotonically_increasing_id()), "jaccard-sets")

    # Counted again over the whole hash range and these sets alone.
    run, schema = _whole_chunks(buckets, chunk_chars // 8)
    at = scratch_path(spark, "jaccard-whole-chunks")
    viable = _marked(stored_at(sets.select("s", "n", "hashes").mapInArrow(run, schema), at), percent).where("suspect").select(F.col("doc_id").alias("s"))
    viable = kept(viable, "jaccard-viable")
    remove(spark, at)
    # The sets are read three times from here on, so they are not shuffled each time to find the viable ones.
    if viable.count() <= MOST_BROADCAST:
        sets = sets.join(F.broadcast(viable), "s", "left_semi")
    else:
        sets = kept(sets.join(viable, "s", "left_semi"), "jaccard-viable-sets")
    items = sets.select("s", F.explode("hashes").alias("h"))
    # The number of holders leads the key of a class, so that keys sort the rarest class first.
    rarity = F.shiftleft(F.least(F.count(F.lit(1)), F.lit(32767)), 48)
    holders = F.shiftrightunsigned(F.bit_xor(F.xxhash64("s")), 16)
    shared = items.groupBy("h").agg(F.count(F.lit(1)).alias("df"), (rarity + holders).alias("key")).where("df > 1")
    shared = kept(shared.select("h", "key"), "jaccard-shared")
    weights = items.join(shared, "h").groupBy("s", "key").agg(F.count(F.lit(1)).alias("w"))
    lists = weights.groupBy("s").agg(F.sum("w").alias("total"), F.sort_array(F.collect_list(F.struct("key", "w"))).alias("c")).join(sets.select("s", "set_id", "n"), "s")
    lists = lists.where(100 * F.col("total") >= percent * F.col("n")).select("set_id", "n", F.col("c.key").alias("keys"), F.col("c.w").cast("array<int>").alias("weights"))
    lists = stored(lists, "jaccard-lists")
    drop()

    run, schema = _leading(percent)
    meets = kept(lists.select("set_id", "n", "keys", "weights").mapInPandas(run, schema), "jaccard-meetings")
    # Of several classes at which the same sets meet, the first in the order is enough.
    met = meets.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("set_id")).alias("who")).where("size > 1")
    met = met.groupBy("who", "size").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("size") / block).cast("int").alias("parts"))
    dealt = meets.join(kept(met, "jaccard-met"), "key").withColumn("part", F.expr("cast(pmod(xxhash64(set_id, key), parts) AS int)"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "set_id")
    blocks = stored(dealt, "jaccard-blocks").join(lists, "set_id")
    drop()
    # Keys are sorted, and what comes before the key of a block is met elsewhere.
    since = lambda c: F.slice(c, F.array_position("keys", F.col("key")).cast("int"), F.size("keys")).alias(c)
    blocks = blocks.select("key", "i", "j", "set_id", "n", since("keys"), since("weights"))
    dealt = blocks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    edges = dealt.select("key", "i", "j", "set_id", "n", "keys", "weights").mapInArrow(_links(percent), "a binary, b binary")
    roots = components(edges, "jaccard")

    named = groups.join(roots, groups["set_id"] == roots["node"], "left").select(groups["set_id"], "first", F.coalesce("root", groups["set_id"]).alias("root"))
    named = stored(named, "jaccard-named")
    smallest = stored(named.groupBy("root").agg(F.min("first").alias("component_id")), "jaccard-smallest")
    found = stored(named.join(smallest, "root").select("set_id", "component_id"), "jaccard-found")
    component = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return marks.join(found, "set_id", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
