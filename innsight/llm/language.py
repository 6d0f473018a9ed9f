"""Language identification as a mixture.

Character trigrams of lower-cased words, word ends included, have one likelihood for each
language, learnt from a bounded sample of labelled documents (``most_documents`` rows with
the smallest hash of their id). A document is a mixture: every word is of one language,
drawn by the document's proportions, which expectation-maximisation estimates from the
word likelihoods. The set of languages is chosen by penalised likelihood (a further
language must gain ``PENALTY`` times the logarithm of the number of words), growing from
the best single language. The prediction is the largest proportion.

Every whole text is judged alone, so there is no shuffle. Defined results: a null, empty
or letterless text is ``und`` with score 0, and so is every text if nothing was learnt;
equal texts have equal results; equal proportions go to the first language by name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.text import batch_column, put

WORD = re.compile(r"[^\W\d_]+")
MOST_DOCUMENTS = 4000
BUCKETS = 1 << 16
SMOOTHING = 0.5
LEAST_WORD = -30.0  # no single word can outweigh a text
PENALTY = 3.0
STEPS = 8
SCHEMA = "lang_pred string, score double, langs array<string>, proportions array<double>"


@dataclass
class Model:
    """Log-likelihood of each trigram bucket (row) under each language (column)."""

    langs: list[str]
    table: np.ndarray


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram of `` word ``, and the number of trigrams of each word (its length)."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    # A word of n letters with its two ends has n trigrams, centred on its letters.
    mixed = codes[:-2] * np.uint64(0x9E3779B1) + codes[1:-1] * np.uint64(0x85EBCA77) + codes[2:] * np.uint64(0xC2B2AE3D)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    centred = (mixed >> np.uint64(48)).astype(np.int64)
    return centred[codes[1:-1] != 32], lengths


def train(rows: list[tuple[str | None, str]]) -> Model:
    """Model from (text, language) pairs; equal texts of a language count once."""
    langs = sorted({lang for _, lang in rows})
    counts = np.zeros((BUCKETS, len(langs)))
    for text, lang in sorted({(t, lang) for t, lang in rows if t}):
        words = WORD.findall(text.lower())
        if words:
            counts[:, langs.index(lang)] += np.bincount(trigrams(words)[0], minlength=BUCKETS)
    counts += SMOOTHING * (counts.sum(1, keepdims=True) + 1) / (counts.sum() + BUCKETS) * BUCKETS / 8
    return Model(langs, np.log(counts / counts.sum(0)).astype(np.float32))


def expected(like: np.ndarray, begin: np.ndarray, doc: np.ndarray, share: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after ``steps`` of expectation-maximisation, and the log-likelihood of each document.

    ``like``: word likelihoods scaled by the word's best; ``begin``, ``doc``: first word of
    each document and document of each word.
    """
    for _ in range(steps):
        joint = like * share[doc]
        total = joint.sum(1, keepdims=True)
        share = np.add.reduceat(joint / np.maximum(total, 1e-300), begin)
        share /= share.sum(1, keepdims=True)
    return share, np.add.reduceat(np.log(np.maximum((like * share[doc]).sum(1), 1e-300)), begin)


def proportions(log_like: np.ndarray, counts: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> np.ndarray:
    """Language proportions of documents with ``counts`` words each; languages outside the chosen set are 0."""
    begin = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    best = log_like.max(1, keepdims=True)
    like = np.exp(np.maximum(log_like - best, LEAST_WORD))
    single = np.add.reduceat(np.log(like), begin)
    size, n = log_like.shape[1], len(counts)
    chosen = np.zeros((n, size))
    chosen[np.arange(n), single.argmax(1)] = 1.0
    value, cost = single.max(1), penalty * np.log(counts + 1.0)
    # No mixture beats the best language of every word, whose log-likelihood is 0 here: most texts end now.
    open_ = np.flatnonzero(-value > cost) if size > 1 else np.zeros(0, int)
    while len(open_):
        words = np.isin(doc, open_)
        sub, sub_counts = like[words], counts[open_]
        sub_begin, sub_doc = np.cumsum(sub_counts) - sub_counts, np.repeat(np.arange(len(open_)), sub_counts)
        now, gain, first = chosen[open_], np.full(len(open_), -np.inf), chosen[open_].copy()
        for lang in range(size):  # the language whose tenth helps most is tried
            start = now * 0.9
            start[:, lang] = np.where(now[:, lang] > 0, now[:, lang], 0.1)
            total = expected(sub, sub_begin, sub_doc, start, 0)[1]
            better = (now[:, lang] == 0) & (total > gain)
            gain, first = np.where(better, total, gain), np.where(better[:, None], start, first)
        new, gain = expected(sub, sub_begin, sub_doc, first, steps)
        grown = gain - value[open_] > cost[open_]
        chosen[open_[grown]], value[open_[grown]] = new[grown], gain[grown]
        open_ = open_[grown & (-gain > cost[open_]) & ((new > 0).sum(1) < size)]
    return chosen


def predicted(model: Model):
    def of(texts: list[str | None]) -> pd.DataFrame:
        found = [WORD.findall(t.lower()) if t else [] for t in texts]
        have = [i for i, w in enumerate(found) if w] if model.langs else []
        lang, score = ["und"] * len(texts), [0.0] * len(texts)
        langs: list[list] = [[] for _ in texts]
        parts: list[list] = [[] for _ in texts]
        if have:
            grams, lengths = trigrams([w for i in have for w in found[i]])
            log_like = np.add.reduceat(model.table[grams], np.cumsum(lengths) - lengths).astype(float)
            share = proportions(log_like, np.array([len(found[i]) for i in have]))
            for i, p in zip(have, share):
                top = int(p.argmax())
                lang[i], score[i] = model.langs[top], float(min(1.0, p[top]))
                order = np.argsort(-p, kind="stable")
                langs[i] = [model.langs[k] for k in order if p[k] > 0]
                parts[i] = [float(p[k]) for k in order if p[k] > 0]
        return pd.DataFrame({"lang_pred": lang, "score": score, "langs": langs, "proportions": parts})

    return of


def fit(docs: DataFrame, held_out, most_documents: int = MOST_DOCUMENTS) -> Model:
    """Learn from documents with a language outside ``held_out``; at most ``most_documents`` reach the driver."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out)
    # Ids are picked first, so that only the picked texts are read.
    picked = known.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_documents).distinct()
    rows = known.select("doc_id", "text", "lang").join(picked, "doc_id").select("text", "lang").collect()
    return train([(r["text"], r["lang"]) for r in rows])


def with_language(df: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``df`` with a struct of prediction, score and the mixture as its last column."""
    return put(df, into, batch_column(SCHEMA, predicted(model), F.col(f"`{text}`"), most_chars=2_000_000))
