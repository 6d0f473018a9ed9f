"""Toxic spans by a linear-chain conditional random field.

``fit`` learns from a bounded sample of labelled documents (``most_documents`` rows, those
with the smallest hash of their id). Document labels become token labels: a word is toxic
where a toxic document uses it and its use follows the label far beyond chance, in ever new
surroundings, so that copies of one document cannot vote many times. The field's weights
(word, first and last three letters, transitions) are fitted to these tags by the exact
gradient from forward-backward. ``with_toxicity`` runs forward-backward over each whole text
and folds the marginals into one score; tokens of marginal 0.5 or more make the spans.

Sequences are sentences. With two tags, the messages are kept as ratios, which need no
rescaling. Defined results: a null, empty or letterless text gets the score of a text
without any toxic token and no spans; equal texts get equal results. Without labelled rows
every score is 0.5 of a coin never tossed: (0 + 1) / (0 + 2), shrunk below one half by
``PRIOR``. Labels are read only by ``fit``.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.llm.text import batch_column, keeps, put, slices, turn_to

TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
ENDERS = ".!?\n"
MOST_DOCUMENTS = 8000
CHANCE = 0.01  # of any wrong word in the whole vocabulary
PRIOR = (1.0, 9.0)  # toxic and clean documents assumed before any is seen
SCHEMA = "score double, predicted int, span_begin array<int>, span_end array<int>"


@dataclass
class Model:
    """Log-odds weights of the tag; a feature that is not listed weighs nothing."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -10.0
    moves: tuple[float, float, float, float] = (1.0, 1.0, 1.0, 1.0)  # clean-clean, clean-toxic, toxic-clean, toxic-toxic
    fold: tuple[float, float, float] = (0.0, 0.0, 0.0)  # constant, largest marginal, log of one plus expected tokens of the spans


def features(word: str) -> tuple[str, str, str]:
    return word, "^" + word[:3], word[-3:] + "$"


def lowered(text: str) -> str:
    """Lower case of the same length, so that offsets hold."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def messages(odds: np.ndarray, lengths: np.ndarray, moves: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward ratios toxic : clean of every token of consecutive sequences."""
    cc, ct, tc, tt = moves
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    ahead, back = np.empty_like(odds), np.ones_like(odds)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # sequences longer than t
    for t in range(longest):
        at = starts[: active[t]] + t
        if t == 0:
            ahead[at] = odds[at]
        else:
            r = ahead[at - 1]
            ahead[at] = odds[at] * (ct + r * tt) / (cc + r * tc)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        e = odds[at + 1] * back[at + 1]
        back[at] = (tc + tt * e) / (cc + ct * e)
    return ahead, back


def numbered(texts: list[str | None]) -> tuple[list[np.ndarray], list[str]]:
    """Each text as the numbers of its tokens, and the vocabulary; sentence ends come first."""
    index = {w: k for k, w in enumerate(ENDERS)}
    docs = [np.fromiter((index.setdefault(w, len(index)) for w in TOKEN.findall(lowered(t))), np.int32) if t else np.zeros(0, np.int32) for t in texts]
    return docs, list(index)


def log_tail(least: int, n: int, rate: float) -> float:
    """Logarithm of the chance that at least ``least`` of ``n`` draws succeed; the same sum at every size."""
    k = range(least, n + 1)
    terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(rate) + (n - i) * math.log1p(-rate) for i in k]
    most = max(terms)
    return most + math.log(sum(math.exp(t - most) for t in terms))


def toxic_words(docs: list[np.ndarray], labels: list[int], size: int) -> np.ndarray:
    """Numbers of the words whose presence follows the label beyond chance, not by copies of one passage."""
    rate = (sum(labels) + PRIOR[0]) / (len(labels) + sum(PRIOR))
    have, toxic = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for words, y in zip(docs, labels):
        found = np.unique(words)
        have[found] += 1
        toxic[found] += bool(y)
    level = CHANCE / max(1, size)
    likely = np.flatnonzero((toxic >= 3) & (2 * toxic > have))
    chosen = {int(w) for w in likely if w >= len(ENDERS) and log_tail(int(toxic[w]), int(have[w]), rate) < math.log(level)}
    around, uses = defaultdict(set), Counter()
    for words, y in zip(docs, labels):
        if y:
            at = np.flatnonzero(np.isin(words, list(chosen)))
            padded = np.concatenate([[-1], words, [-1]])
            for i in at:
                uses[int(words[i])] += 1
                around[int(words[i])].add((int(padded[i]), int(padded[i + 2])))
    return np.array(sorted(w for w in chosen if 2 * len(around[w]) > uses[w]), np.int64)


def fit_field(docs: list[np.ndarray], labels: list[int], vocabulary: list[str], steps: int = 50, most_tokens: int = 250_000) -> Model:
    """Weights from all ``docs``; the gradient is summed over groups of about ``most_tokens`` tokens, which bounds memory only."""
    lexicon = toxic_words(docs, labels, len(vocabulary))
    if not len(lexicon):
        return Model()
    common = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=len(vocabulary))
    flat = np.concatenate([x for d in docs for x in (d, np.zeros(1, np.int32))])
    label = np.repeat([bool(y) for y in labels], [len(d) + 1 for d in docs])
    ends = np.flatnonzero(flat < len(ENDERS))
    lengths = np.diff(np.concatenate([[-1], ends])) - 1
    lengths, word = lengths[lengths > 0], flat >= len(ENDERS)
    tags = (np.isin(flat, lexicon) & label)[word]
    tokens, place = np.unique(flat[word], return_inverse=True)
    place = place.astype(np.int32)
    del flat, label, word, ends
    index: dict[str, int] = {}
    # A rare word keeps its endings only, as a word never seen does.
    rows = [[index.setdefault(x, len(index)) if k or common[w] > 2 else -1 for k, x in enumerate(features(vocabulary[w]))] for w in tokens]
    at = np.array(rows, np.int32)
    at[at < 0] = len(index)
    groups = []  # sentences of like length together: tokens, tags, lengths
    order, starts = np.argsort(-lengths, kind="stable"), np.cumsum(lengths) - lengths
    for a, b in slices(lengths[order].tolist(), most_tokens):
        own = lengths[order[a:b]]
        token = np.arange(own.sum()) + np.repeat(starts[order[a:b]] - np.cumsum(own) + own, own)
        groups.append((place[token], tags[token], own))
    n, toxic = len(tags), float(tags.sum())
    del place, tags, starts, order
    theta = np.zeros(len(index) + 1 + 4)  # features, the absent one, bias, three moves
    theta[-4] = math.log((toxic + 1) / (n + 1))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        theta[len(index)] = 0.0
        each = np.exp(np.clip(theta[at].sum(1) + theta[-4], -30, 30))  # odds of each distinct token
        moves = (1.0, *np.exp(np.clip(theta[-3:], -8, 8)))
        gaps, change = np.zeros(len(tokens)), np.zeros(3)
        for token, tag, own in groups:
            odds, tag = each[token], tag.astype(float)
            ahead, back = messages(odds, own, moves)
            first = np.zeros(len(tag), bool)
            first[np.cumsum(own) - own] = True
            here = np.flatnonzero(~first)
            was, now = tag[here - 1], tag[here]
            r, e = ahead[here - 1], odds[here] * back[here]
            total = moves[0] + moves[1] * e + moves[2] * r + moves[3] * r * e
            change += [np.sum((1 - was) * now - moves[1] * e / total), np.sum(was * (1 - now) - moves[2] * r / total), np.sum(was * now - moves[3] * r * e / total)]
            both = ahead * back
            gaps += np.bincount(token, tag - both / (1 + both), len(tokens))
        slope = np.concatenate([sum(np.bincount(at[:, k], gaps, len(index) + 1) for k in range(3)), [gaps.sum()], change])
        slope -= 0.1 * theta
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta += 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = {x: float(theta[k]) for x, k in index.items() if abs(theta[k]) > 0.01}
    return Model(weights, float(theta[-4]), (1.0, *map(float, np.exp(np.clip(theta[-3:], -8, 8)))))


class Odds(dict):
    """Odds of each token by the model, kept for tokens met again; NaN ends a sentence."""

    MOST = 150_000

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.update(dict.fromkeys(ENDERS, math.nan))

    def __missing__(self, word: str) -> float:
        if len(self) > self.MOST:
            self.clear()
            self.update(dict.fromkeys(ENDERS, math.nan))
            if word in self:
                return math.nan
        get = self.model.weights.get
        a, b, c = features(word)
        out = self[word] = math.exp(max(-30.0, min(30.0, self.model.bias + get(a, 0.0) + get(b, 0.0) + get(c, 0.0))))
        return out


def marginals(texts: list[str | None], odds: Odds) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each text the marginal of every token that is no sentence end, and its token number."""
    values, counts = [], []
    for text in texts:
        found = TOKEN.findall(lowered(text)) if text else []
        counts.append(len(found))
        values.append(np.fromiter(map(odds.__getitem__, found), float, len(found)))
    # A sentence ends with its text as well.
    flat = np.concatenate([x for v in values for x in (v, [math.nan])]) if values else np.zeros(0)
    ends = np.flatnonzero(np.isnan(flat))
    lengths = np.diff(np.concatenate([[-1], ends])) - 1
    is_word = ~np.isnan(flat)
    ahead, back = messages(flat[is_word], lengths[lengths > 0], odds.model.moves)
    both = np.full(len(flat), math.nan)
    both[is_word] = ahead * back / (1 + ahead * back)
    out, numbers, at = [], [], 0
    for n in counts:
        own = both[at : at + n]
        at += n + 1
        number = np.flatnonzero(~np.isnan(own))
        out.append(own[number])
        numbers.append(number)
    return out, numbers


def folded(parts: list[np.ndarray]) -> np.ndarray:
    """Largest marginal and expected tokens of the spans; a long clean text adds up to nothing."""
    return np.array([[1.0, p.max(initial=0.0), math.log1p(p[p >= 0.5].sum())] for p in parts]).reshape(-1, 3)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Newton's method; the ridge keeps separable data finite."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        beta = beta + np.linalg.solve(curve, x.T @ (y - p) - ridge * beta)
    return beta


def train(rows: list[tuple[str | None, int]]) -> Model:
    """Model from (text, toxic) pairs."""
    distinct = dict(rows)  # one vote for each text
    docs, vocabulary = numbered(list(distinct))
    model = fit_field(docs, [int(y) for y in distinct.values()], vocabulary)
    del docs, vocabulary
    odds = Odds(model)
    parts = [folded(marginals([t for t, _ in rows[k : k + 200]], odds)[0]) for k in range(0, len(rows), 200)]
    x = np.vstack([*parts, np.tile([1.0, 0.0, 0.0], (2, 1))])
    y = np.array([float(y) for _, y in rows] + [1.0, 0.0])
    if len(rows) < 10 or y.sum() < 2:
        rate = (y.sum() - 1 + PRIOR[0]) / (len(rows) + sum(PRIOR))
        return Model(model.weights, model.bias, model.moves, (math.log(rate / (1 - rate)), 0.0, 0.0))
    return Model(model.weights, model.bias, model.moves, tuple(map(float, logistic(x, y))))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's decimal text falls into the fold; an absent id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most_documents: int = MOST_DOCUMENTS, folds: int = 5, fold: int = 0) -> Model:
    """Train on labelled documents outside the fold; at most ``most_documents`` of them reach the driver."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id"), folds, fold))
    picked = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_documents)
    rows = docs.select("doc_id", "text").join(picked, "doc_id").select("text", "_toxic").orderBy("text", "_toxic").collect()
    return train([(r["text"], int(r["_toxic"] > 0)) for r in rows])


def scored(model: Model):
    def of(texts: list[str | None]) -> pd.DataFrame:
        turn_to("toxicity")
        odds = scored.cache.get(id(model))
        if odds is None:
            scored.cache.clear()
            odds = scored.cache[id(model)] = Odds(model)
        parts, numbers = marginals(texts, odds)
        x = folded(parts) @ np.array(model.fold)
        score = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
        begins, ends = [], []
        for text, p, number in zip(texts, parts, numbers):
            bad = set(number[p >= 0.5].tolist())
            spans: list[list[int]] = []
            if bad:
                last = -2
                for k, m in enumerate(TOKEN.finditer(lowered(text))):
                    if k in bad:
                        if k == last + 1:
                            spans[-1][1] = m.end()
                        else:
                            spans.append([m.start(), m.end()])
                        last = k
            begins.append([s[0] for s in spans])
            ends.append([s[1] for s in spans])
        return pd.DataFrame({"score": score, "predicted": (score >= 0.5).astype(np.int32), "span_begin": begins, "span_end": ends})

    return of


scored.cache = {}
keeps("toxicity", scored.cache.clear)


def with_toxicity(df: DataFrame, model: Model, text: str = "text", into: str = "toxicity") -> DataFrame:
    """``df`` with a struct of score, verdict and offending character ranges as its last column."""
    return put(df, into, batch_column(SCHEMA, scored(model), F.col(f"`{text}`")))
