"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and benchmark items become words (ASCII lower case, ASCII signs as spaces). The CGK random walk over a window reads one word a step and stays or moves on
by a random bit of step and word; two windows at small edit distance fall back into step, so their walks agree in most places. A repetition of the LSH samples
SAMPLED places of one walk into a key.

Walks are short, so that some pass between the edits of a copy at any length of the item: documents are walked from starts a stride apart, items from every word,
as long as the walk ends inside the item. Steps, stride and repetitions are derived from the item's length and the edits allowed, so that the expected recall of copies
with the most edits, spread at random, is TARGET. A key match is a candidate if enough words around it are the item's, and is verified by the exact edit distance between the item
and the best substring of the document there (Myers' bit vectors): at most EDITS of the item's words may be inserted, deleted or replaced.

Items are handled in blocks of BLOCK items and BLOCK_WORDS words, one pass over the documents each. However many items share a key, their candidates are compared CANDIDATES at a time, stretch
by stretch of a text, and none is left out, so memory is bounded for any benchmark but for the words of one text; items of frequent words cost time in proportion to how often their keys match.
Null or empty texts and items match nothing, and so does an empty table of either. Texts may be of any length. A document row and an item give at most one hit, the best, then the first. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import keys_of, mix64, read_table

#: Edits allowed, as a share of an item's words.
EDITS = 0.2
#: Expected share of copies with that many edits that are found.
TARGET, SAMPLED = 0.97, 3
#: Steps of a walk with the stride of its starts, and repetitions, that are tried for the target.
SHAPES, REPETITIONS = ((12, 4), (12, 2), (9, 2), (6, 2), (6, 1), (4, 1), (3, 1), (1, 1)), (1, 2, 3, 4, 6, 8)
#: Words of an item above which its plan doesn't change.
MODELLED = 64
#: Items in a block.
BLOCK = 20_000
#: Words that the blocks of items hold at most, but for single items.
BLOCK_WORDS = 1_000_000
#: Marks by which an item's words are told at sight.
MARKS = 1024

_WORDS = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
#: Words behind a text that no walk gets past.
_PAD = 64
#: Candidates that are compared at a time, and words of texts that are walked at a time, but for single longer texts.
CANDIDATES, RUN = 500_000, 500_000
#: A copy of an item keeps one of its rarest words, one more than edits are allowed. Up to FEW of them are looked for, in stretches of so many words, by so many bins of words.
FEW, STRETCH, BINS = 4, 128, 8192
#: Bits for the place of a candidate in its text, which may begin before it.
_PLACE, _SHIFT = 32, 1 << 24
#: Bits of a key by which most windows without an item are told.
SEEN = 20


def word_keys(text: str | None) -> np.ndarray:
    return keys_of((text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split())


def marks_of(words: np.ndarray) -> np.ndarray:
    return (mix64(words) % np.uint64(MARKS)).astype(np.int64)


def places(steps: int, repetition: int) -> list[int]:
    """Steps that a repetition samples, one from each part, for else a word that the walk stays on would be sampled twice."""
    rng = np.random.default_rng([steps, repetition])
    edges = np.linspace(0, steps, SAMPLED + 1).astype(int)
    return [int(rng.integers(x, max(x + 1, y))) for x, y in zip(edges, edges[1:])]


@lru_cache(None)
def recall(n_words: int, steps: int, stride: int, repetitions: int, least: int, edits: float = EDITS) -> float:
    """Expected share of copies with the most edits that such walks find, if an edited word ends a walk.

    Copies and walks are drawn; walks start at each stride from a random alignment on, and count if they pass the least words and end inside the copy."""
    rng = np.random.default_rng([n_words, steps, stride, repetitions])
    trials = 400
    edited = np.argsort(rng.random((trials, n_words)), 1) < int(edits * n_words)
    ahead = np.minimum.accumulate(np.where(edited, np.arange(n_words), n_words)[:, ::-1], 1)[:, ::-1]  # the first edited word from each on, or the end
    grid = (np.arange(n_words) - rng.integers(0, stride, (trials, 1))) % stride == 0
    found = np.zeros(trials, bool)
    for repetition in range(repetitions):
        passed = rng.binomial(places(steps, repetition)[-1], 0.5, (trials, n_words))
        found |= (grid & (passed >= least) & (np.arange(n_words) + passed < ahead)).any(1)
    return float(found.mean())


@lru_cache(None)
def plan(n_words: int, edits: float = EDITS) -> tuple[int, int, int, int]:
    """Steps, stride, repetitions and least words passed for an item: the most telling keys, then the fewest walks, whose expected recall is TARGET.

    Longer items than MODELLED have more starts, so they need no more than those."""
    n_words = min(n_words, MODELLED)
    for least in (2, 1, 0):
        for steps, stride in SHAPES:
            for repetitions in REPETITIONS:
                if recall(n_words, steps, stride, repetitions, least, edits) >= TARGET:
                    return steps, stride, repetitions, least
    return 1, 1, 1, 0


class Coins:
    """The random bits of all steps and words of one array, 64 steps at a time."""

    def __init__(self, words: np.ndarray):
        self.words, self.made = words, {}

    def __call__(self, repetition: int, block: int) -> np.ndarray:
        if (repetition, block) not in self.made:
            seed = 0xA0761D6478BD642F * (repetition + 1) + 0xE7037ED1A0B428DB * block & (2**64 - 1)
            self.made[repetition, block] = mix64(self.words ^ np.uint64(seed)).view(np.int64)
        return self.made[repetition, block]


def walk(coins: Coins, starts: np.ndarray, steps: int, repetition: int) -> tuple[np.ndarray, np.ndarray]:
    """LSH keys of the walks from starts, and the places of their last words. Behind the last start the words are padded."""
    words, wanted = coins.words, places(steps, repetition)
    at = starts
    key = np.zeros(len(starts), np.uint64)
    for step in range(wanted[-1] + 1):
        for _ in range(wanted.count(step)):
            key = mix64(key ^ words[at])
        if step < wanted[-1]:
            bits = coins(repetition, step // 64)[at]
            bits >>= step % 64
            bits &= 1
            at = at + bits
    return key, at


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edits between the item and any substring of the text, and the end of the first such substring."""
    m = len(item)
    peq: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        peq[w] = peq.get(w, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, w in enumerate(text.tolist()):
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (full & ~(xh | pv)), pv & xh
        score += bool(ph & high) - bool(mh & high)
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def bins_of(words: np.ndarray) -> np.ndarray:
    return (mix64(words ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(BINS)).astype(np.int64)


def rarest(items: list[np.ndarray], allowed: np.ndarray) -> np.ndarray:
    """Bins of each item's words that are rarest among the items, one more than edits are allowed, so that a copy keeps one of them; -1 throughout where that are more than FEW."""
    out = np.full((len(items), FEW), -1)
    if not items:
        return out
    distinct, place, count = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    bins, ends = bins_of(distinct), np.cumsum([len(x) for x in items])
    for n, (end, x, most) in enumerate(zip(ends, items, allowed)):
        if most < FEW:
            own = place[end - len(x) : end]
            first = bins[own[np.argsort(count[own], kind="stable")[: most + 1]]]
            out[n] = np.r_[first, np.repeat(first[:1], FEW - len(first))]
    return out


class Stretches:
    """Which bins of words occur in each stretch of 2 * STRETCH words, one from every STRETCH words on."""

    def __init__(self, words: np.ndarray):
        at, bins = np.arange(len(words)) // STRETCH, bins_of(words)
        self.there = np.zeros((len(words) // STRETCH + 1) * BINS, bool)
        self.there[at * BINS + bins] = True
        self.there[np.maximum(at - 1, 0) * BINS + bins] = True

    def hold(self, first: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """Whether the STRETCH words from each first one on may hold one of the words, or no words are given."""
        out, base = rare[:, 0] < 0, np.maximum(first, 0) // STRETCH * BINS
        for k in range(FEW):
            out = out | self.there[base + rare[:, k]]
        return out


@dataclass
class Index:
    """A block of items: for each kind of walk and repetition the sorted keys with item and offset, and each item's marks."""

    ids: list[int]
    items: list[np.ndarray]
    tables: list[tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    marks: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    allowed: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rare: np.ndarray = field(default_factory=lambda: np.zeros((0, FEW), np.int64))

    @classmethod
    def build(cls, rows: list[tuple[int, str | None]], edits: float = EDITS) -> Index:
        kept = [(i, k) for i, t in rows if len(k := word_keys(t))]
        index = cls([i for i, _ in kept], [k for _, k in kept])
        index.marks = np.zeros(len(index.items) * MARKS, bool)
        index.allowed = np.array([int(edits * len(k)) for k in index.items], np.int64)
        index.rare = rarest(index.items, index.allowed)
        by_plan: dict[tuple[int, int, int, int], list[int]] = {}
        for n, words in enumerate(index.items):
            by_plan.setdefault(plan(len(words), edits), []).append(n)
            index.marks[n * MARKS + marks_of(words)] = True
        found: dict[tuple[int, int, int], list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for (steps, stride, repetitions, least), members in sorted(by_plan.items()):
            sizes = np.array([len(index.items[n]) for n in members])
            coins = Coins(np.concatenate([*(index.items[n] for n in members), np.zeros(_PAD, np.uint64)]))
            starts, ends = np.arange(sizes.sum()), np.repeat(np.cumsum(sizes), sizes)
            owners, offsets = np.repeat(np.array(members, np.int32), sizes), (starts - ends + np.repeat(sizes, sizes)).astype(np.int32)
            for repetition in range(repetitions):
                keys, last = walk(coins, starts, steps, repetition)
                inside = (last < ends) & (last - starts >= least)
                found.setdefault((steps, stride, repetition), []).append((keys[inside], owners[inside], offsets[inside]))
        for (steps, stride, repetition), some in sorted(found.items()):
            keys, owners, offsets = (np.concatenate(x) for x in zip(*some))
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << SEEN, bool)
            seen[(keys >> np.uint64(64 - SEEN)).astype(np.int64)] = True
            index.tables.append((steps, stride, repetition, keys[order], owners[order], offsets[order], seen))
        return index

    def probes(self, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each kind of walk: the starts whose key some items have, where these begin in the key's table, how many they are, and the table's items and offsets. words are padded by _PAD."""
        n, coins, out = len(words) - _PAD, Coins(words), []
        for steps, stride, repetition, keys, owners, offsets, seen in self.tables:
            starts = np.arange(0, n, stride)
            found, _ = walk(coins, starts, steps, repetition)
            hit = np.flatnonzero(seen[(found >> np.uint64(64 - SEEN)).astype(np.int64)])
            low, high = np.searchsorted(keys, found[hit], "left"), np.searchsorted(keys, found[hit], "right")
            some = high > low
            out.append((starts[hit[some]], low[some], (high - low)[some], owners, offsets))
        return out

    def candidates(self, words: np.ndarray, most: int = CANDIDATES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Starts, the places where an item could begin, and the items, for a run of words that is padded by _PAD: about `most` at a time, stretch by stretch of the words.

        All that match at one start come together, so a stretch of one start may have more, but no more than the block of items has words, for each kind of walk."""
        probes = self.probes(words)
        total = np.zeros(len(words), np.int64)
        for starts, _, count, *_ in probes:
            total[starts] += count
        upto = np.cumsum(total)
        edges = np.unique(np.r_[0, np.searchsorted(upto, np.arange(most, upto[-1], most), "left") + 1, len(words)])
        for x, y in zip(edges, edges[1:]):
            found = []
            for starts, low, count, owners, offsets in probes:
                a, b = np.searchsorted(starts, [x, y])
                if a < b:
                    n = count[a:b]
                    each = np.repeat(low[a:b] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    at = np.repeat(starts[a:b], n)
                    found.append((at, at - offsets[each], owners[each]))
            if found:
                yield tuple(np.concatenate(c) for c in zip(*found))

    def alike(self, words: np.ndarray, first: np.ndarray, lengths: np.ndarray, item: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Whether runs of words hold at least so many words with a mark of the item; every word of the item has one."""
        out, marks = np.zeros(len(first), bool), marks_of(words)
        cuts = np.searchsorted(np.cumsum(lengths), np.arange(0, lengths.sum(), 1 << 20))
        for a, b in zip(cuts, [*cuts[1:], len(first)]):
            if a < b:
                n, before = lengths[a:b], np.cumsum(lengths[a:b]) - lengths[a:b]
                at = np.repeat(first[a:b] - before, n) + np.arange(n.sum())
                out[a:b] = np.add.reduceat(self.marks[np.repeat(item[a:b] * MARKS, n) + marks[at]], before, dtype=np.int64) >= least[a:b]
        return out

    def hits(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(row, item, edits, end word) of verified matches, the best of each row and item. Texts are handled some at a time, RUN words or one text, and their candidates CANDIDATES at a time."""
        rows = [word_keys(t) for t in texts]
        upto = np.cumsum([len(r) for r in rows])
        out, a = [], 0
        while a < len(rows):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + RUN, "right")))
            out += [(a + r, *x) for r, *x in self.verified(rows[a:b])]
            a = b
        return out

    def verified(self, rows: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
        sizes_of, lengths_of = np.array([len(x) for x in self.items], np.int64), np.array([len(x) for x in rows], np.int64)
        ends, flat = np.cumsum(lengths_of), np.concatenate([*rows, np.zeros(_PAD, np.uint64)])
        best: dict[tuple[int, int], tuple[int, int]] = {}
        if not self.items:
            return []
        stretches = Stretches(flat)
        for start, begin, item in self.candidates(flat):
            kept = stretches.hold(begin - self.allowed[item] - 8, self.rare[item])
            start, begin, item = start[kept], begin[kept], item[kept]
            # the words of a match are of the text in which its walk starts; matches of one item within four words of each other are looked at once
            row = np.searchsorted(ends, start, "right")
            inside = row < len(rows)
            row, begin, item = row[inside], begin[inside], item[inside]
            quarter = (begin - (ends[row] - lengths_of[row])) // 4 + _SHIFT
            packed = np.unique(((row * len(self.items) + item) << _PLACE) | quarter)
            both, b = packed >> _PLACE, (packed & ((1 << _PLACE) - 1)) - _SHIFT
            r, i = both // len(self.items), both % len(self.items)
            sizes, lengths = sizes_of[i], lengths_of[r]
            allowed = self.allowed[i]
            low = np.maximum(0, 4 * b - allowed - 4)
            high = np.minimum(lengths, 4 * b + 4 + sizes + 2 * allowed + 4)
            some = np.flatnonzero(high - low >= np.maximum(1, sizes - allowed))
            some = some[self.alike(flat, ends[r[some]] - lengths[some] + low[some], high[some] - low[some], i[some], (sizes - allowed)[some])]
            for r, i, low, high, m, most in zip(*(x[some].tolist() for x in (r, i, low, high, sizes, allowed))):
                if best.get((r, i), (m, 0))[0] > 0:
                    if np.isin(self.items[i], rows[r][low:high]).sum() < m - most:  # every word that isn't there is an edit
                        continue
                    found, end = best_match(self.items[i], rows[r][low:high])
                    if found <= most:
                        best[r, i] = min(best.get((r, i), (m, 0)), (found, low + end))
        return [(r, i, *x) for (r, i), x in best.items()]


def blocks(benchmark: DataFrame, size: int = BLOCK, words: int = BLOCK_WORDS) -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks of bounded size, one at a time on the driver."""
    block: list[tuple[int, str | None]] = []
    held = 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        n = len(word_keys(r[1]))
        if block and (len(block) == size or held + n > words):
            yield block
            block, held = [], 0
        block.append((r[0], r[1]))
        held += n
    if block:
        yield block


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_edits, n_item_words, end_word: one row for each document and item that it contains."""
    context = docs.sparkSession.sparkContext
    out = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_edits int, n_item_words int, end_word int")
    for block in blocks(benchmark):
        shared = context.broadcast(Index.build(block))

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                hits = index.hits(batch.column(1).to_pylist())
                ids = batch.column(0).to_pylist()
                columns = [[ids[r] for r, *_ in hits], [index.ids[i] for _, i, *_ in hits], [e for *_, e, _ in hits], [len(index.items[i]) for _, i, *_ in hits], [x for *_, x in hits]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k < 2 else pa.int32()) for k, c in enumerate(columns)], names=["doc_id", "item_id", "n_edits", "n_item_words", "end_word"])

        out = out.unionByName(docs.select("doc_id", "text").mapInArrow(step, out.schema))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that contain no item, all columns; nothing is shuffled."""
    context, at = docs.sparkSession.sparkContext, docs.columns.index("text")
    for block in blocks(benchmark):
        shared = context.broadcast(Index.build(block))

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[r for r, *_ in shared.value.hits(batch.column(at).to_pylist())]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(step, docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
