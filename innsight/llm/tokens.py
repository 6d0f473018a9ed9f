"""Token ids of whole texts by the tokenizers library, each distinct word encoded once."""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np

from innsight.llm.text import keeps, turn_to

END = 1  # id that closes every document
LETTERS, DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
#: Texts of these characters are cut alike by the file's pattern and by Python's re.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]*")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Encodes lists of texts; keeps at most ``most`` words.

    A file that lower-cases and cuts by one pattern before a byte-level BPE encodes every
    cut alone, so equal words have equal ids wherever they stand. Texts with characters
    beyond Latin-1, with a special token's string, or files of another kind go to the
    library whole.
    """

    def __init__(self, path: str, most: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.whole, self.most, self.cache = Tokenizer.from_file(path), most, {}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.pattern = _word_pattern(spec)
        # Cut words of plain text are normalised already.
        self.parts = Tokenizer.from_str(json.dumps({**spec, "normalizer": None}))
        # Every cut of such a file ends with a token of this kind, and no other token has it.
        suffix = spec["model"].get("end_of_word_suffix")
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[k for w, k in vocabulary.items() if w.endswith(suffix)]] = True

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids without special tokens, unsigned 32-bit little-endian; none for a null text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        found: dict[int, list[str]] = {}
        rest = []
        for i, text in enumerate(texts):
            if not text:
                out[i] = np.zeros(0, "<u4")
            elif self.pattern and PLAIN.fullmatch(text) and not any(s in text for s in self.special):
                found[i] = self.pattern.findall(text.lower())
            else:
                rest.append(i)
        for i, e in zip(rest, self.whole.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, "<u4")
        if len(self.cache) > self.most:
            self.cache.clear()
        new = list(set().union(*found.values()).difference(self.cache))
        for k in range(0, len(new), 20_000):
            self._learn(new[k : k + 20_000])
        for i, words in found.items():
            out[i] = np.frombuffer(b"".join(map(self.cache.__getitem__, words)), "<u4")
        return out


    def _learn(self, words: list[str]) -> None:
        """Keep the ids of ``words``, encoded as lines and taken apart at the word ends."""
        lines = [" ".join(words[k : k + 64]) for k in range(0, len(words), 64)]
        ids = np.concatenate([np.array(e.ids, "<u4") for e in self.parts.encode_batch_fast(lines, add_special_tokens=False)])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            raw, at = ids.tobytes(), [0, *(4 * ends).tolist()]
            self.cache.update(zip(words, (raw[a:b] for a, b in zip(at, at[1:]))))
        else:  # no such ends: one by one
            self.cache.update((w, np.array(self.whole.encode(w, add_special_tokens=False).ids, "<u4").tobytes()) for w in words)


def _word_pattern(spec: dict) -> re.Pattern | None:
    """The file's cutting pattern for lower-cased Latin-1 text, or None if it works otherwise."""
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return None
    if steps[1]["pattern"].get("Regex") != r"\s+" or spec["model"].get("dropout") or spec.get("post_processor"):
        return None
    cut, level = cuts
    if cut["behavior"] != "Removed" or not cut["invert"] or level["use_regex"] or level["add_prefix_space"]:
        return None
    pattern = cut["pattern"]["Regex"].replace(r"\p{L}", LETTERS).replace(r"\p{N}", DIGITS)
    return None if "\\p" in pattern else re.compile(pattern)


_encoder = lru_cache(maxsize=2)(Encoder)
keeps("tokens", _encoder.cache_clear)


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file, until another operator takes its turn there."""
    turn_to("tokens")
    return _encoder(path)


def closed(ids: np.ndarray, end: int = END) -> np.ndarray:
    return np.append(ids, np.array([end], "<u4")).astype("<u4", copy=False)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())
