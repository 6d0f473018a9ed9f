"""Hidden Markov language model over word classes.

A token's probability in a latent state is P(class | state) * P(token | class). A class is
one of the ``FREQUENT`` most frequent training tokens, or the word's ending. P(token | class)
comes from the counts of all training documents, add one over the class's tokens and one
unknown. Baum-Welch trains start, transition and class probabilities: in every round each
chunk of texts adds up its expected counts, and the sums over all chunks give the next
model. The score of a text is exact: the scaled forward recursion over its whole token
sequence. Training and scoring are over whole texts; a longer one than ``PIECE`` tokens is
cut only to run its pieces side by side, and products of the pieces' matrices carry the
forward and the backward state over every cut.

Counts of any number of tokens go through no single place: a chunk of texts merges its own
tokens, deals the distinct ones out by hash range, each range sums them and answers every
chunk in the chunk's own order. Only class totals, the frequent tokens and the model, all
of fixed size, reach the driver.

Defined results: a null, empty or wordless text is one end token; repeated rows count and
are scored each; a document without an id is learnt from and never held out; without
training documents every count is 0 and the model keeps its start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.text import WORD, ascii_lower, slices
from innsight.llm.tables import stored

STATES, FREQUENT, ENDINGS, ROUNDS, PIECE = 6, 256, 255, 4, 512
GROUP = 400_000  # tokens of the texts that are taken at once; bounds memory only
END = "\n"  # no word holds white space
CLASSES = ENDINGS + 1 + FREQUENT  # endings, the end token, frequent tokens
_META = np.dtype([("doc_id", "<i8"), ("known", "?"), ("out", "?"), ("tokens", "<i8")])
_ENTRY = np.dtype([("hash", "<u8"), ("n", "<u4"), ("class", "<u2")])


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states by classes

    @staticmethod
    def fresh(totals: np.ndarray, states: int = STATES) -> "Model":
        """Near the class frequencies, with fixed noise that tells the states apart."""
        rng = np.random.default_rng(17)
        emit = (totals + 1.0) * rng.uniform(0.5, 1.5, (states, len(totals)))
        move = rng.uniform(0.5, 1.5, (states, states)) + np.eye(states)
        return Model(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))

    @staticmethod
    def of(counts: np.ndarray, states: int, classes: int) -> "Model":
        """From expected counts laid out as start, moves, emissions; smoothed, so that nothing is impossible."""
        start, move = counts[:states] + 0.1, counts[states : states + states**2].reshape(states, states) + 0.1
        emit = counts[states + states**2 :].reshape(states, classes) + 0.01
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


class Lockstep:
    """Consecutive sequences side by side, the longest first: step t holds token t of each one longer than t."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        starts, longest = (np.cumsum(lengths) - lengths)[self.order], int(lengths.max(initial=0))
        self.active = np.searchsorted(-lengths[self.order], -np.arange(longest), side="left")
        self.edges = np.concatenate([[0], np.cumsum(self.active)]).astype(np.int64)
        self.row = np.arange(self.edges[-1]) - np.repeat(self.edges[:-1], self.active)  # of each token's sequence in the order
        self.tokens = starts[self.row] + np.repeat(np.arange(longest), self.active)
        self.rank = np.empty(len(lengths), np.int64)
        self.rank[self.order] = np.arange(len(lengths))


def _products(classes: np.ndarray, lengths: np.ndarray, opens: np.ndarray, model: Model) -> np.ndarray:
    """For each sequence the product of its tokens' move and emission matrices, up to a factor; one that opens a text begins with the start."""
    side, states = Lockstep(lengths), len(model.start)
    emit = model.emit.T[classes[side.tokens]]
    out = np.where(opens[side.order, None, None], np.diag(model.start), model.move)
    for t, n in enumerate(side.active):
        e = emit[side.edges[t] : side.edges[t + 1], None, :]
        out[:n] = (out[:n] if t == 0 else (out[:n].reshape(-1, states) @ model.move).reshape(n, states, states)) * e
        if t % 8 == 7:
            out[:n] /= out[:n].sum((1, 2))[:, None, None]
    return (out / out.sum((1, 2))[:, None, None])[side.rank]


def _borders(classes: np.ndarray, lengths: np.ndarray, model: Model, piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts cut into pieces that know what lies beyond their borders, so that pieces run side by side and nothing is lost.

    Lengths of the pieces, the first piece of each text, the state distribution each piece
    begins with, and the backward weights (up to a factor) it ends with.
    """
    cut, count = pieces(lengths, piece), -(-lengths // piece)
    heads = np.cumsum(count) - count
    before, after = np.tile(model.start, (len(cut), 1)), np.ones((len(cut), len(model.start)))
    if (count > 1).any():
        several = np.repeat(count > 1, count)
        opens = np.zeros(len(cut), bool)
        opens[heads] = True
        products = np.zeros((len(cut), len(model.start), len(model.start)))
        products[several] = _products(classes[np.repeat(several, cut)], cut[several], opens[several], model)
        order = np.argsort(-count, kind="stable")
        first, active = heads[order], np.searchsorted(-count[order], -np.arange(1, count.max()), side="left")  # texts with a piece k + 1
        alpha = np.ones((len(order), len(model.start)))
        for k, n in enumerate(active):
            alpha = np.einsum("ni,nij->nj", alpha[:n], products[first[:n] + k])
            alpha /= alpha.sum(1, keepdims=True)
            before[first[:n] + k + 1] = alpha @ model.move
        for k in range(len(active) - 1, -1, -1):
            at = first[: active[k]] + k
            beta = np.einsum("nij,nj->ni", products[at + 1], after[at + 1])
            after[at] = beta / beta.sum(1, keepdims=True)
    return cut, heads, before, after


def likelihood(classes: np.ndarray, lengths: np.ndarray, model: Model, piece: int = 0) -> np.ndarray:
    """Natural log-likelihood of consecutive class sequences by the scaled forward recursion."""
    cut, heads, before, _ = _borders(classes, lengths, model, piece or PIECE)
    side = Lockstep(cut)
    emit, scale, alpha = model.emit.T[classes[side.tokens]], np.empty(len(classes)), before[side.order]
    for t, n in enumerate(side.active):
        now = slice(side.edges[t], side.edges[t + 1])
        alpha = (alpha if t == 0 else alpha[:n] @ model.move) * emit[now]
        scale[now] = alpha.sum(1)
        alpha /= scale[now, None]
    out = np.bincount(side.row, np.log(scale), len(cut))[side.rank]
    return np.add.reduceat(out, heads) if len(heads) else out


def expectations(classes: np.ndarray, lengths: np.ndarray, model: Model, piece: int = 0) -> np.ndarray:
    """Expected counts of Baum-Welch over consecutive sequences, laid out for ``Model.of``."""
    cut, heads, before, after = _borders(classes, lengths, model, piece or PIECE)
    side, states = Lockstep(cut), len(model.start)
    emit, edges = model.emit.T[classes[side.tokens]], side.edges
    alpha, scale = np.empty((len(classes), states)), np.empty(len(classes))
    for t, n in enumerate(side.active):
        now = slice(edges[t], edges[t + 1])
        own = emit[now] * (before[side.order] if t == 0 else alpha[edges[t - 1] : edges[t - 1] + n] @ model.move)
        scale[now] = own.sum(1)
        alpha[now] = own / scale[now, None]
    emit /= scale[:, None]
    last = alpha[edges[cut[side.order] - 1] + np.arange(len(cut))]
    beta, moves = after[side.order], np.zeros((states, states))
    beta /= (last * beta).sum(1, keepdims=True)
    for t in range(len(side.active) - 1, -1, -1):
        now = slice(edges[t], edges[t + 1])
        if t + 1 < len(side.active):
            n = side.active[t + 1]
            e = emit[edges[t + 1] : edges[t + 2]] * beta[:n]
            moves += alpha[edges[t] : edges[t] + n].T @ e
            beta[:n] = e @ model.move.T
        alpha[now] *= beta[: side.active[t]]
    opens = np.zeros(len(cut), bool)
    opens[heads] = True
    later = np.flatnonzero(~opens)  # pieces whose first token follows another piece's last one
    at = side.rank[later]
    moves += last[side.rank[later - 1]].T @ (emit[at] * beta[at])
    first, flat = alpha[side.rank[heads]].sum(0), classes[side.tokens]
    seen = [np.bincount(flat, alpha[:, k], model.emit.shape[1]) for k in range(states)]
    return np.concatenate([first, (moves * model.move).ravel(), *seen])


def pieces(lengths: np.ndarray, most: int = PIECE) -> np.ndarray:
    """Lengths of the pieces of at most ``most`` tokens that sequences are cut into."""
    counts = -(-lengths // most)
    out = np.full(int(counts.sum()), most, np.int64)
    ends = np.cumsum(counts) - 1
    out[ends] = lengths - (counts - 1) * most
    return out


def groups(classes: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Whole texts of about ``GROUP`` tokens together: their classes and lengths."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    for a, b in slices(lengths.tolist(), GROUP):
        yield classes[ends[a] : ends[b]], lengths[a:b]


class Numbers(dict):
    """Number of each word in the order of first sight."""

    def __missing__(self, word: str) -> int:
        out = self[word] = len(self)
        return out


def ending(word: str) -> int:
    return ENDINGS if word == END else zlib.crc32(word[-2:].encode("utf-8", "replace")) % ENDINGS


def _chunks(buckets: int, folds: int, fold: int, chunk_chars: int):
    """Texts to rows of one chunk: its documents and token numbers (bucket -1), its distinct tokens by hash range."""
    schema = pa.schema([("chunk", pa.string()), ("bucket", pa.int32()), ("docs", pa.binary()), ("tokens", pa.binary()), ("entries", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in slices([len(t or "") for t in texts], chunk_chars):
                numbers, flat, meta = Numbers(), [], []
                for i, text in zip(ids[a:b], texts[a:b]):
                    found = WORD.findall(ascii_lower(text)) if text else []
                    found.append(END)
                    flat.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                    out = i is not None and zlib.crc32(str(i).encode()) % folds == fold
                    meta.append((i or 0, i is not None, out, len(found)))
                docs = np.array(meta, _META)
                hashes, place = np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, numbers), np.uint64, len(numbers)), return_inverse=True)
                tokens = place[np.concatenate(flat)].astype("<i4")  # numbers in the order of hashes
                entries = np.zeros(len(hashes), _ENTRY)
                entries["hash"] = hashes
                entries["n"] = np.bincount(tokens[~np.repeat(docs["out"], docs["tokens"])], minlength=len(hashes))
                entries["class"][place] = np.fromiter(map(ending, numbers), np.uint16, len(numbers))
                bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                edges = np.searchsorted(bucket, np.arange(buckets + 1))
                name, number = f"{part}-{number}", number + 1
                rows = [(name, -1, docs.tobytes(), tokens.tobytes(), (entries["hash"].tobytes() + entries["class"].tobytes()))]
                rows += [(name, k, b"", b"", entries[x:y].tobytes()) for k, (x, y) in enumerate(zip(edges, edges[1:])) if x < y]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run, "chunk string, bucket int, docs binary, tokens binary, entries binary"


def _summed(bucket: pd.DataFrame) -> pd.DataFrame:
    """Totals of one hash range: an answer for each chunk, and one row (no chunk) for the whole range."""
    sizes = bucket["entries"].map(len).to_numpy() // _ENTRY.itemsize
    entries = np.frombuffer(b"".join(bucket["entries"]), _ENTRY)
    hashes, first, place = np.unique(entries["hash"], return_index=True, return_inverse=True)
    totals = np.zeros(len(hashes), np.int64)
    np.add.at(totals, place, entries["n"].astype(np.int64))
    own, ends = totals[place].astype("<i8"), np.cumsum(sizes)
    classes = entries["class"][first]
    by_class = np.zeros((ENDINGS + 1, 2), np.int64)  # tokens, distinct tokens
    np.add.at(by_class, classes, np.stack([totals, totals > 0], 1))
    top = np.lexsort((hashes, -totals))[:FREQUENT]
    top = top[(totals[top] > 0) & (classes[top] < ENDINGS)]
    best = np.stack([hashes[top].view(np.int64), totals[top], classes[top].astype(np.int64)], 1)
    number = int(bucket["bucket"].iloc[0])
    rows = [(c, number, own[e - n : e].tobytes(), b"") for c, n, e in zip(bucket["chunk"], sizes, ends)]
    rows.append((None, number, by_class.astype("<i8").tobytes(), best.astype("<i8").tobytes()))
    return pd.DataFrame(rows, columns=["chunk", "bucket", "totals", "best"])


@dataclass
class Lexicon:
    """What is known of all training tokens: the frequent ones, and tokens and distinct tokens of each class."""

    frequent: np.ndarray  # hashes, sorted
    tokens: np.ndarray
    distinct: np.ndarray

    @staticmethod
    def of(by_class: np.ndarray, best: np.ndarray) -> "Lexicon":
        best = best[np.lexsort((best[:, 0].view(np.uint64), -best[:, 1]))][:FREQUENT]
        best = best[np.argsort(best[:, 0].view(np.uint64))]
        counts = np.zeros((CLASSES, 2), np.int64)
        counts[: ENDINGS + 1] = by_class
        np.subtract.at(counts, best[:, 2], np.stack([best[:, 1], np.ones(len(best), np.int64)], 1))
        counts[ENDINGS + 1 : ENDINGS + 1 + len(best)] = np.stack([best[:, 1], np.ones(len(best), np.int64)], 1)
        return Lexicon(best[:, 0].view(np.uint64).copy(), counts[:, 0], counts[:, 1])

    def classes(self, vocabulary: bytes) -> np.ndarray:
        """Class of each token number of a chunk."""
        n = len(vocabulary) // 10
        hashes, out = np.frombuffer(vocabulary, "<u8", n), np.frombuffer(vocabulary, "<u2", n, 8 * n).astype(np.int32)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
            same = self.frequent[at] == hashes
            out[same] = ENDINGS + 1 + at[same]
        return out


def _expected(lexicon: Lexicon, model: Model):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(STATES + STATES**2 + STATES * CLASSES)
        for frame in frames:
            for docs, tokens, vocabulary in zip(frame["docs"], frame["tokens"], frame["entries"]):
                docs, tokens = np.frombuffer(docs, _META), np.frombuffer(tokens, "<i4")
                classes = lexicon.classes(vocabulary)[tokens[~np.repeat(docs["out"], docs["tokens"])]]
                for own, lengths in groups(classes, docs["tokens"][~docs["out"]]):
                    total += expectations(own, lengths, model)
        yield pd.DataFrame({"position": np.arange(len(total)), "value": total})

    return run


def _scores(lexicon: Lexicon, model: Model, n_tokens: int, n_distinct: int):
    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        whole = chunk[chunk["bucket"] < 0].iloc[0]
        docs, tokens = np.frombuffer(whole["docs"], _META), np.frombuffer(whole["tokens"], "<i4")
        counts = np.frombuffer(b"".join(chunk[chunk["bucket"] >= 0].sort_values("bucket")["totals"]), "<i8")
        classes = lexicon.classes(whole["entries"])
        base = np.log10((counts + 1) / (n_tokens + n_distinct + 1))
        inside = np.log((counts + 1) / (lexicon.tokens[classes] + lexicon.distinct[classes] + 1))
        begin = np.cumsum(docs["tokens"]) - docs["tokens"]
        over = lambda x: np.add.reduceat(x[tokens], begin)
        along = [likelihood(own, lengths, model) for own, lengths in groups(classes[tokens], docs["tokens"])]
        score = (np.concatenate(along) + over(inside)) / np.log(10)
        return pd.DataFrame({
            "doc_id": pd.arrays.IntegerArray(docs["doc_id"].copy(), ~docs["known"]), "held_out": docs["out"].copy(), "n_tokens": docs["tokens"].copy(),
            "n_known": over((counts > 0).astype(np.int64)), "train_tokens": n_tokens, "base_score": over(base), "score": score,
        })

    return run


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, fold: int = 2, rounds: int = ROUNDS, chunk_chars: int = 8_000_000) -> DataFrame:
    """Train on the documents outside the fold (crc32 of the id's text modulo ``folds``) and score every row."""
    spark = docs.sparkSession
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    run, schema = _chunks(buckets, folds, fold, chunk_chars)
    chunks = stored(own.mapInArrow(run, schema), "lm-chunks")
    sums = chunks.where("bucket >= 0").select("chunk", "bucket", "entries").groupBy("bucket").applyInPandas(_summed, "chunk string, bucket int, totals binary, best binary")
    sums = stored(sums, "lm-sums")
    ranges = sums.where("chunk IS NULL").select("totals", "best").collect()  # one row for each hash range
    by_class = sum((np.frombuffer(r["totals"], "<i8").reshape(-1, 2) for r in ranges), np.zeros((ENDINGS + 1, 2), np.int64))
    lexicon = Lexicon.of(by_class, np.concatenate([np.zeros((0, 3), np.int64), *(np.frombuffer(r["best"], "<i8").reshape(-1, 3) for r in ranges)]))

    whole, model = chunks.where("bucket < 0"), Model.fresh(lexicon.tokens)
    for _ in range(rounds):
        counts = whole.select("docs", "tokens", "entries").mapInPandas(_expected(lexicon, model), "position long, value double")
        counts = counts.groupBy("position").agg(F.sum("value").alias("value")).toPandas().sort_values("position")  # the size of the model
        if not len(counts):
            break
        model = Model.of(counts["value"].to_numpy(), STATES, CLASSES)
    nothing = F.lit(None).cast("binary")
    both = whole.select("chunk", "bucket", "docs", "tokens", "entries", nothing.alias("totals")).union(
        sums.where("chunk IS NOT NULL").select("chunk", "bucket", nothing, nothing, nothing, "totals"))
    return both.groupBy("chunk").applyInPandas(_scores(lexicon, model, int(by_class[:, 0].sum()), int(by_class[:, 1].sum())), SCHEMA)
