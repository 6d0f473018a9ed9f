"""SentencePiece models on the tokenizers library.

``parse`` reads the model's protobuf; ``Backend`` rebuilds from it the normaliser (character
map, dummy prefix, white space), the white-space marker, the unigram scores or the merges
that the scores of a BPE model imply, and byte fallback. Batches go through the library's
threads. Where no piece crosses a marker, text is cut at the markers and each
distinct part is encoded once.

``with_pieces`` encodes every whole text and says whether decoding gives the text back, and
whether the sentencepiece library agrees: each distinct part is compared with it when it is
first met (parts are independent, so a text agrees if its parts do; tests compare whole
texts), and a text is compared whole where parts are not independent.

Defined results: a null or empty text has no ids and agrees; equal texts have equal ids.
A text that holds the marker itself decodes to spaces there, and says so. Models with
user-defined pieces are refused.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.text import batch_column, put
from innsight.llm.tokens import crc

MARK = "▁"
# Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SCHEMA = "n_tokens long, ids_crc32 long, round_trip boolean, parity boolean"


def wire(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        yield number, data[at : at + size]
        at += size


@dataclass
class ModelFile:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)  # text, score, type
    kind: int = UNIGRAM
    unknown: int = 0
    byte_fallback: bool = False
    characters: bytes = b""
    prefix: bool = True
    squeeze: bool = True
    escape: bool = True
    mark_after: bool = False


def parse(data: bytes) -> ModelFile:
    out = ModelFile()
    for number, value in wire(data):
        if number == 1:
            piece = dict(wire(value))
            out.pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
        elif number == 2:
            spec = dict(wire(value))
            out.kind, out.byte_fallback, out.mark_after = spec.get(3, UNIGRAM), bool(spec.get(35, 0)), bool(spec.get(24, 0))
        elif number == 3:
            spec = dict(wire(value))
            out.characters, out.prefix = spec.get(2, b""), bool(spec.get(3, 1))
            out.squeeze, out.escape = bool(spec.get(4, 1)), bool(spec.get(5, 1))
    out.unknown = next((k for k, p in enumerate(out.pieces) if p[2] == UNKNOWN), 0)
    return out


def merges(file: ModelFile) -> list[tuple[str, str]]:
    """Pairs in the order in which the scores let them merge."""
    number = {p: k for k, (p, _, kind) in enumerate(file.pieces) if kind == NORMAL}
    out = []
    for piece, k in number.items():
        halves = [(piece[:i], piece[i:]) for i in range(1, len(piece)) if piece[:i] in number and piece[i:] in number]
        out += [(-file.pieces[k][1], k, number[a], number[b], a, b) for a, b in halves]
    return [(a, b) for *_, a, b in sorted(out)]


THREADS = 2  # of the library in each task


class Backend:
    """Encoder and decoder of one model file."""

    MOST = 600_000

    def __init__(self, path: str, threads: int = 1, verify: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        with open(path, "rb") as source:
            file = self.file = parse(source.read())
        if file.mark_after or any(kind == USER_DEFINED for *_, kind in file.pieces):
            raise ValueError("user-defined pieces and trailing markers are not supported")
        if file.kind == UNIGRAM:
            worst = min(score for _, score, _ in file.pieces) - 1000.0
            vocabulary = [(p, s if kind == NORMAL else worst) for p, s, kind in file.pieces]
            model = models.Unigram(vocabulary, unk_id=file.unknown, byte_fallback=file.byte_fallback)
        elif file.kind == BPE:
            vocabulary = {p: k for k, (p, _, _) in enumerate(file.pieces)}
            model = models.BPE(vocab=vocabulary, merges=merges(file), unk_token=file.pieces[file.unknown][0], fuse_unk=True, byte_fallback=file.byte_fallback)
        else:
            raise ValueError(f"model type {file.kind} is not supported")
        steps = [normalizers.Precompiled(file.characters)] if file.characters else []
        if file.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if file.prefix:
            steps.append(normalizers.Prepend(MARK if file.escape else " "))
        if file.escape:
            steps.append(normalizers.Replace(" ", MARK))
        self.whole = Tokenizer(model)
        self.normalizer = normalizers.Sequence(steps)
        self.whole.normalizer = self.normalizer
        strip = [decoders.Strip(" ", 1, 0)] if file.prefix else []
        self.whole.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
        self.parts = Tokenizer(model)  # of text that is normalised already
        # Parts are independent if a marker can only open a piece.
        crossing = any(MARK in p.lstrip(MARK) for p, _, kind in file.pieces if kind == NORMAL)
        self.cut = None if crossing or not file.escape else re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        if self.cut is not None:
            self.parts.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
        self.opens = np.array([p.startswith(MARK) for p, *_ in file.pieces])
        self.verify, self.wrong = library(path) if verify else None, set()
        self.plain = not file.characters and not file.squeeze
        self.cache: dict[str, bytes] = {}
        byte = lambda p: bytes([int(p[3:5], 16)])
        self.raw = [byte(p) if kind == BYTE else p.replace(MARK, " ").encode() for p, _, kind in file.pieces]
        self.direct = np.array([kind in (NORMAL, BYTE) for *_, kind in file.pieces])

    def normalised(self, text: str) -> str:
        if self.plain and text:
            return ((MARK if self.file.prefix else "") + text).replace(" ", MARK)
        return self.normalizer.normalize_str(text)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if self.cut is None:
            return [np.array(e.ids, "<u4") for e in self.whole.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        found = [self.cut.findall(self.normalised(t)) if t else [] for t in texts]
        if len(self.cache) > self.MOST:
            self.cache.clear()
        new = list(set().union(*found).difference(self.cache))
        for k in range(0, len(new), 20_000):
            self._learn(new[k : k + 20_000])
        return [np.frombuffer(b"".join(map(self.cache.__getitem__, words)), "<u4") for words in found]

    def _learn(self, parts: list[str]) -> None:
        """Keep the ids of ``parts``, most of them encoded as lines and taken apart where pieces open a part."""
        simple = [p for p in parts if p[0] == MARK and p.count(MARK) == 1]
        lines = ["".join(simple[k : k + 64]) for k in range(0, len(simple), 64)]
        ids = np.concatenate([np.zeros(0, "<u4"), *(np.array(e.ids, "<u4") for e in self.parts.encode_batch_fast(lines, add_special_tokens=False))])
        begins = np.flatnonzero(self.opens[ids])
        if len(begins) == len(simple):
            raw, at = ids.tobytes(), [*(4 * begins).tolist(), 4 * len(ids)]
            self.cache.update(zip(simple, (raw[a:b] for a, b in zip(at, at[1:]))))
        rest = [p for p in parts if p not in self.cache]
        self.cache.update(zip(rest, (np.array(e.ids, "<u4").tobytes() for e in self.parts.encode_batch_fast(rest, add_special_tokens=False))))
        if self.verify is not None:
            # The library puts one marker in front itself, and takes nothing but that for an empty text.
            begin = self.verify.encode("a")
            blank = [p for p in parts if not p.strip(MARK)]
            own = [p for p in parts if p[0] == MARK and p.strip(MARK)] if self.file.prefix else [p for p in parts if p.strip(MARK)]
            plain = [p[1:] if self.file.prefix else p for p in own]
            self.wrong.update(p for p, ids in zip(own, self.verify.encode(plain, num_threads=1)) if array("I", ids).tobytes() != self.cache[p])
            self.wrong.update(p for p in blank if array("I", self.verify.encode("a" + " " * len(p))[len(begin) :]).tobytes() != self.cache[p])

    def agrees(self, text: str | None, ids: np.ndarray) -> bool:
        """Whether the sentencepiece library gives these ids."""
        if self.cut is None or not self.plain:
            return self.verify.encode(text or "") == ids.tolist()
        return not self.wrong or not text or self.wrong.isdisjoint(self.cut.findall(self.normalised(text)))

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        out: list[str | None] = [None] * len(ids)
        for k, own in enumerate(ids):
            if not len(own):
                out[k] = ""
            elif self.direct[own].all():
                try:
                    text = b"".join(map(self.raw.__getitem__, own.tolist())).decode()
                except UnicodeDecodeError:  # bytes of no character: the library knows what to put
                    continue
                out[k] = text[1:] if self.file.prefix and text.startswith(" ") else text
        rest = [k for k, t in enumerate(out) if t is None]
        for k, text in zip(rest, self.whole.decode_batch([ids[k].tolist() for k in rest], skip_special_tokens=False)):
            out[k] = text
        return out


@lru_cache(maxsize=2)
def backend(path: str, threads: int = 1, verify: bool = False) -> Backend:
    """One backend for each Python worker, file and mode."""
    return Backend(path, threads, verify)


@lru_cache(maxsize=2)
def library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _encoded(path: str, threads: int, verify: bool):
    def of(texts: list[str | None]) -> pd.DataFrame:
        known = backend(path, threads, verify)
        ids = known.encode(texts)
        same = [a == (t or "") for a, t in zip(known.decode(ids), texts)]
        agrees = [known.agrees(t, x) for t, x in zip(texts, ids)] if verify else [None] * len(texts)
        return pd.DataFrame({"n_tokens": [len(x) for x in ids], "ids_crc32": [crc(x) for x in ids], "round_trip": same, "parity": agrees})

    return of


def with_pieces(df: DataFrame, path: str | None = None, text: str = "text", into: str = "pieces", threads: int = THREADS, verify: bool = True) -> DataFrame:
    """``df`` with a struct of the counts and checks of ``SCHEMA`` as its last column; ``parity`` is null without ``verify``."""
    return put(df, into, batch_column(SCHEMA, _encoded(path or default_path(), threads, verify), F.col(f"`{text}`"), most_chars=2_000_000))


def with_ids(df: DataFrame, path: str | None = None, text: str = "text", into: str = "ids", threads: int = 1) -> DataFrame:
    """``df`` with the ids themselves, an array of int, as its last column."""
    where = path or default_path()
    of = lambda texts: pd.DataFrame({"ids": [x.astype(np.int32) for x in backend(where, threads).encode(texts)]})
    return put(df, into, batch_column("ids array<int>", of, F.col(f"`{text}`"), most_chars=2_000_000).getField("ids"))


def with_text(df: DataFrame, path: str | None = None, ids: str = "ids", into: str = "text", threads: int = 1) -> DataFrame:
    """``df`` with the text that ``ids`` decode to as its last column; null ids decode to an empty text."""
    where = path or default_path()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(backend(where, threads).decode([np.zeros(0, "<u4") if x is None else np.asarray(x, "<u4") for x in batch]), dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return put(df, into, F.pandas_udf(run, "string")(F.col(f"`{ids}`")))
