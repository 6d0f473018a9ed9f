"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

1. Runs of letters are counted per text and task, then by Spark; of every hash class of
   (document, run) one loses a letter, which plants slips of the pen to be found again.
2. Letters are dealt to ``GROUPS`` groups of about equal weight. A word's counts per group are
   its path through a trie, first the counts of a few coarse groups (unions of groups), which
   name a cell, then those of every group. The number of coarse groups follows from the
   largest cell that each number would make.
3. One edit raises at most one count by one (the surplus) and lowers at most one by one (the
   deficit). A word stays in its own cell and visits those cells that differ from it by one
   surplus, or by a surplus before a deficit; the other half of the differences is found from
   the other word. Cells are dealt by hash, and no pair of words is shuffled.
4. In a cell a depth-first search takes batches of words down the trie, spending the surplus
   and the deficit where the visit says they must be spent, and leaves paths that no word has.
   Words at a leaf are compared letter by letter.
5. A word's form is its nearest frequent relative; roots follow by doubling the steps.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innsight.llm.decontaminate import small
from innsight.llm.tables import stored
from innsight.llm.text import ascii_lower, scrambled

LEAST_LETTERS, LEAST_COUNT, TIMES, SLIP = 7, 2, 10, 31
GROUPS, MOST_COARSE, CELL = 20, 9, 10_000
WIDE = 40  # letters of a word compared in a matrix; longer ones one by one
_STATE, _FREE = -2, -1  # of a word in its own cell; of a budget that is not to be spent
_STEPS = scrambled(np.arange(1, 256, dtype=np.uint64))


def run_counts(doc_id: int | None, text: str | None, least: int = LEAST_LETTERS, slip: int = SLIP) -> dict[str, int]:
    """Words of one text of at least ``least`` letters, and how often; a text without an id loses no letter."""
    found: dict[str, int] = {}
    if not text:
        return found
    start = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
    for word, n in Counter(_pattern(least).findall(ascii_lower(text))).items():
        if start is not None:
            h = zlib.crc32(word.encode(), start)
            if h % slip == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
                if len(word) < least:
                    continue
        found[word] = found.get(word, 0) + n
    return found


_PATTERNS: dict[int, re.Pattern] = {}


def _pattern(least: int) -> re.Pattern:
    """Whole runs of at least ``least`` letters: a match begins where its run begins."""
    if least not in _PATTERNS:
        _PATTERNS[least] = re.compile("[a-zÀ-ÿ]{%d,}" % least)
    return _PATTERNS[least]


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n) of all whole texts."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.update(run_counts(i, t, least, slip))
                if len(held) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=schema)
                    held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], schema=schema)

    own = docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string"))
    return own.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Groups:
    """Letters to groups, and groups to coarse groups, of about equal weight each.

    ``of``: the group of each character; groups are numbered by coarse group. ``coarse``: the
    coarse group of each group. Given the same letter counts every task builds the same.
    """

    def __init__(self, weights: Sequence[int], groups: int = GROUPS, coarse: int = 3):
        dealt, totals = self._dealt(weights, groups)
        upper, _ = self._dealt(totals, coarse)
        ranked = sorted(range(groups), key=lambda g: (upper[g], g))
        number = np.empty(groups, np.int64)
        number[ranked] = np.arange(groups)
        self.of, self.coarse, self.size = number[np.array(dealt)], np.array([upper[g] for g in ranked]), coarse
        self.last = [g for g in range(groups) if g == groups - 1 or self.coarse[g] != self.coarse[g + 1]]

    @staticmethod
    def _dealt(weights: Sequence[int], groups: int) -> tuple[list[int], list[int]]:
        """Each item, the heaviest first, goes to the lightest group so far."""
        totals, out = [0] * groups, [0] * len(weights)
        for item in sorted(range(len(weights)), key=lambda k: (-weights[k], k)):
            out[item] = min(range(groups), key=lambda g: (totals[g], g))
            totals[out[item]] += weights[item] + 1
        return out, totals

    def counts(self, words: Sequence[str]) -> np.ndarray:
        """Words x groups."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        at = np.repeat(np.arange(len(words)), lengths) * len(self.coarse) + self.of[flat]
        return np.bincount(at, minlength=len(words) * len(self.coarse)).reshape(len(words), -1)

    def cells(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word's cell, and what one more of each coarse group adds to it."""
        upper = np.zeros((len(counts), self.size), np.int64)
        for g, c in enumerate(self.coarse):
            upper[:, c] += counts[:, g]
        steps = _STEPS[200 : 200 + self.size]
        return (upper.astype(np.uint64) * steps).sum(1, dtype=np.uint64), steps


def _letter_weights(words: DataFrame) -> list[int]:
    """How often each character occurs in the distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer("".join(batch.column(0).to_pylist()).encode("latin-1"), np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(range(256), pa.int32()), pa.array(total)], names=["c", "n"])

    found = {r.c: r.n for r in words.select("word").mapInArrow(run, "c int, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()}
    return [found.get(c, 0) for c in range(256)]


def choose_groups(words: DataFrame, groups: int = GROUPS, most: int = CELL, most_coarse: int = MOST_COARSE) -> Groups:
    """The fewest coarse groups whose largest cell has at most ``most`` words, else ``most_coarse``."""
    weights = _letter_weights(words)
    most_coarse = min(most_coarse, groups)  # a coarse group without a group could spend nothing
    tried = {c: Groups(weights, groups, c) for c in range(2, most_coarse + 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(0).to_pylist()
            for c, g in tried.items():
                cells, n = np.unique(g.cells(g.counts(listed))[0].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([c] * len(cells), pa.int32()), pa.array(cells), pa.array(n.astype(np.int64))], names=["c", "cell", "n"])

    sizes = words.select("word").mapInArrow(run, "c int, cell long, n long").groupBy("c", "cell").agg(F.sum("n").alias("n")).groupBy("c").agg(F.max("n").alias("n"))
    fit = [r.c for r in sizes.collect() if r.n <= most]
    return tried[min(fit, default=most_coarse)]


def _visits(groups: Groups):
    """Each word once in its own cell, and in the cells it visits, with the coarse groups of surplus and deficit."""
    schema = pa.schema([("cell", pa.int64()), ("s", pa.int8()), ("d", pa.int8()), ("word", pa.string()), ("n", pa.int64())])
    moves = [(i, _FREE) for i in range(groups.size)] + [(i, j) for i in range(groups.size) for j in range(i + 1, groups.size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, steps = groups.cells(groups.counts(batch.column("word").to_pylist()))
            for s, d in [(_STATE, _STATE), *moves]:
                to = cells if s == _STATE else cells + steps[s] - (steps[d] if d != _FREE else np.uint64(0))
                marks = [pa.array(np.full(len(to), x, np.int8)) for x in (s, d)]
                yield pa.RecordBatch.from_arrays([pa.array(to.view(np.int64)), *marks, batch.column("word"), batch.column("n")], schema=schema)

    return run, "cell long, s byte, d byte, word string, n long"


class Trie:
    """Words of one or more cells by the counts of their groups, kept as the sorted keys of each level."""

    def __init__(self, counts: np.ndarray, cells: np.ndarray, groups: Groups):
        self.groups, self.steps = groups, _STEPS[: len(groups.coarse)]
        key, self.levels = cells.copy(), []
        for g, step in enumerate(self.steps):
            key = key + counts[:, g].astype(np.uint64) * step
            self.levels.append(np.unique(key))
        self.order = np.argsort(key, kind="stable")
        self.leaves, self.first, self.held = np.unique(key[self.order], return_index=True, return_counts=True)
        self.place = np.empty(len(key), np.int64)
        self.place[self.order] = np.arange(len(key))
        self.full = key

    def node(self, level: int, keys: np.ndarray) -> np.ndarray:
        """Whether a path of ``level`` + 1 counts exists."""
        known = self.levels[level]
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return known[at] == keys

    def search(self, counts: np.ndarray, cells: np.ndarray, s: np.ndarray, d: np.ndarray, batch: int = 40_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asking word, leaf) pairs; depth first, the deepest batch of paths is always the next.

        ``cells``: keys of the cells searched; ``s``, ``d``: coarse groups of the surplus and of
        the deficit, or free. Both in the same group: the surplus comes first.
        """
        todo = [(0, np.arange(a, min(a + batch, len(cells))), cells[a : a + batch], s[a : a + batch], d[a : a + batch]) for a in range(0, len(cells), batch)]
        while todo:
            level, q, key, s_left, d_left = todo.pop()
            if level == len(self.steps):
                at = np.searchsorted(self.leaves, key)
                yield q, at
                continue
            own, step, group = counts[q, level], self.steps[level], self.groups.coarse[level]
            base = key + own.astype(np.uint64) * step
            must = level in self.groups.last
            open_s, open_d = s_left == group, d_left == group
            plain = np.flatnonzero(~(open_s | open_d)) if must else np.arange(len(q))
            more = np.flatnonzero(open_s & ~(open_d & must))
            less = np.flatnonzero(open_d & ~open_s & (own > 0))
            q = np.concatenate([q[plain], q[more], q[less]])
            key = np.concatenate([base[plain], base[more] + step, base[less] - step])
            s_next = np.concatenate([s_left[plain], np.full(len(more), _FREE, s_left.dtype), s_left[less]])
            d_next = np.concatenate([d_left[plain], d_left[more], np.full(len(less), _FREE, d_left.dtype)])
            there = np.flatnonzero(self.node(level, key))
            for a in range(0, len(there), batch):
                part = there[a : a + batch]
                todo.append((level + 1, q[part], key[part], s_next[part], d_next[part]))

    def words(self, q: np.ndarray, leaf: np.ndarray, most: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(asking word, word) for every word of each leaf, about ``most`` at a time."""
        ends = np.cumsum(self.held[leaf])
        a = 0
        while a < len(leaf):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
            n = self.held[leaf[a:b]]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(q[a:b], n), self.order[np.repeat(self.first[leaf[a:b]], n) + inside]
            a = b

    def same(self, most: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of words at the same leaf, each pair once."""
        ends = self.first + self.held
        rest = np.repeat(ends, self.held) - 1 - np.arange(len(self.order))  # words after each, at its leaf
        sums, a = np.cumsum(rest), 0
        while a < len(rest):
            b = max(a + 1, int(np.searchsorted(sums, (sums[a - 1] if a else 0) + most, "right")))
            n = rest[a:b]
            left = np.repeat(np.arange(a, b), n)
            right = left + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield self.order[left], self.order[right]
            a = b


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced character."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


class Spelling:
    """Words as rows of a matrix, compared many pairs at once."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.rows = np.frombuffer(b"".join(w[:WIDE].encode("latin-1").ljust(WIDE + 1, b"\0") for w in words), np.uint8).reshape(len(words), WIDE + 1)

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Positions of the pairs one edit apart."""
        gap = self.length[b] - self.length[a]
        long = (self.length[a] > WIDE) | (self.length[b] > WIDE)
        equal = np.flatnonzero((gap == 0) & ~long)
        out = [equal[np.count_nonzero(self.rows[a[equal]] != self.rows[b[equal]], axis=1) == 1]]
        other = np.flatnonzero((np.abs(gap) == 1) & ~long)
        short, more = np.where(gap[other] > 0, a[other], b[other]), np.where(gap[other] > 0, b[other], a[other])
        x, y = self.rows[short], self.rows[more]
        first = (x != y).argmax(1)  # the longer word has a letter where the shorter one ended
        behind = x[:, :-1] != y[:, 1:]
        last = np.where(behind.any(1), WIDE - 1 - behind[:, ::-1].argmax(1), -1)
        out.append(other[last < first])
        out.append(np.array([k for k in np.flatnonzero(long) if one_edit(self.words[a[k]], self.words[b[k]])], np.int64))
        return np.concatenate(out)


def near_pairs(words: list[str], cells: np.ndarray, s: np.ndarray, d: np.ndarray, groups: Groups) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions one edit apart; rows in state ``_STATE`` are at home, the others visit."""
    home, away = np.flatnonzero(s == _STATE), np.flatnonzero(s != _STATE)
    if not len(home):
        return home, home
    counts, spelling = groups.counts(words), Spelling(words)
    trie = Trie(counts[home], cells[home], groups)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        near = spelling.near(a, b)
        found.append((a[near], b[near]))

    for a, b in trie.same():
        keep(home[a], home[b])
    asking = [np.repeat(home, groups.size), away]
    inner = np.tile(np.arange(groups.size, dtype=np.int8), len(home))
    at = np.concatenate(asking)
    for q, leaf in trie.search(counts[at], cells[at], np.concatenate([inner, s[away]]), np.concatenate([inner, d[away]])):
        for a, b in trie.words(q, leaf):
            keep(at[a], home[b])
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _relatives(groups: Groups, rows: int):
    """For the words of whole cells: how many near words, and the most frequent of them (ties: the first in code points)."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("most", pa.int64()), ("form", pa.string())])

    def told(table: pa.Table) -> pa.RecordBatch:
        words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        cells, s, d = table.column("cell").to_numpy().view(np.uint64), table.column("s").to_numpy(), table.column("d").to_numpy()
        a, b = near_pairs(words, cells, s, d, groups)
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
        rank = np.empty(len(words), np.int64)
        rank[pc.sort_indices(table.column("word").combine_chunks()).to_numpy()] = np.arange(len(words))
        order = np.lexsort((rank[b], -n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.diff(a, prepend=-1))
        columns = [[words[k] for k in a[first]], np.diff(first, append=len(a)), n[b[first]], [words[k] for k in b[first]]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; whole cells are taken together up to about ``rows``."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names))  # the same fields as what was left
            if sum(map(len, held)) < rows:
                continue
            table = pa.Table.from_batches(held)
            cell = table.column("cell").to_numpy()
            edge = int(np.flatnonzero(cell != cell[-1])[-1]) + 1 if cell[0] != cell[-1] else 0
            if edge:
                yield told(table.slice(0, edge))
                pa.default_memory_pool().release_unused()
                held = pa.Table.from_arrays([c.take(pa.array(range(edge, len(table)))) for c in table.columns], names=table.column_names).to_batches()
        if held:
            yield told(pa.Table.from_batches(held))

    return run, "word string, n_near long, most long, form string"


def relatives(words: DataFrame, groups: Groups, rows: int = 60_000) -> DataFrame:
    """(word, n_near, most, form) of all words with a near word."""
    run, schema = _visits(groups)
    visits = words.mapInArrow(run, schema)
    home = stored(visits.where(F.col("s") == _STATE).select("cell").distinct(), "variants-cells")
    dealt = visits.join(small(home), "cell", "left_semi").repartition("cell").sortWithinPartitions("cell")
    run, schema = _relatives(groups, rows)
    best = F.min(F.struct((-F.col("most")).alias("less"), "form")).alias("best")
    parts = dealt.mapInArrow(run, schema).groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return parts.select("word", "n_near", (-F.col("best.less")).alias("most"), "best.form")


def roots(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) for (word, form): the last word reached, in chains of at most ``steps`` forms."""
    known = stored(forms.select("word", F.col("form").alias("root")), "variants-roots")
    reach = 1
    while reach < steps:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        known = stored(known.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "variants-roots")
        reach *= 2
    return known


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, times: int = TIMES, slip: int = SLIP,
    groups: int = GROUPS, cell: int = CELL, rows: int = 60_000,
) -> DataFrame:
    """(word, n, form, form_n, n_near, root): one row for each distinct word of ``docs``.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, only A-Z lower-cased, of at least ``least``
    letters and ``least_count`` occurrences. ``form``: the near word of largest count (ties:
    smallest in code points), if it occurs at least ``times`` as often as the word, else null;
    ``root``: the last form reached from the word, itself without one. A null, empty or
    letterless text has no words; a text without an id loses no letters; repeated rows count
    each time. Other columns are not read. An empty table gives no rows.
    """
    words = stored(word_counts(docs, doc_id, text, least, least_count, slip), "variants-words")
    top = words.agg(F.max("n")).first()[0]
    near = stored(relatives(words, choose_groups(words, groups, cell), rows), "variants-near")
    linked = stored(words.join(near, "word").where(F.col("most") >= times * F.col("n")).select("word", "form", F.col("most").alias("form_n")), "variants-forms")
    # Counts grow at least ``times`` fold along a chain, so the largest bounds its length.
    steps = 1
    while top and times > 1 and times ** (steps + 1) <= top:
        steps += 1
    last = roots(linked, steps)
    joined = words.join(near.select("word", "n_near"), "word", "left").join(linked, "word", "left").join(last, "word", "left")
    return joined.select("word", "n", "form", "form_n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.coalesce("root", "word").alias("root"))
