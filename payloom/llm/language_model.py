"""Language-model scoring with an Elias-Fano n-gram trie.

The model is an interpolated trigram with absolute discounting over the add-one unigram p(w) = (c(w) + 1) / (N + V + 1):
p(w | v) = f(w | v) + b(v) p(w) with f = (c(vw) - D) / c(v) and b(v) = D times the distinct successors of v / c(v), and p(w | uv) = f(w | uv) + b(uv) p(w | v) likewise. What wasn't seen has
f = 0, and a context that wasn't seen b = 1, so each level sums to one with one unknown word. Counts are over all training documents (crc32 of doc_id modulo 7 isn't 2), without pruning or
caps. D = 0.75 is the usual discount of one-count n-grams; it isn't fitted.

Neither the model nor the counts ever sit in one place:

1. Documents are packed into chunks. A chunk asks for its distinct n-grams, nested by first word, second and third, with its own training counts.
2. Requests go to the shard of the first word. A shard adds up the counts and builds its part of the trie: level 1 holds words with exact counts, levels 2 and 3 the successors of each
   node of the level above. A level is one monotone sequence in Elias-Fano code: a node's successors, as 32-bit keys, go on from the last value of the node before; pointers, a monotone
   sequence, too, say where a node's range begins and ends. f and b are quantised to one byte. The levels lie in a memory-mapped temporary file that lives
   as long as the task. An n-gram is found by successor search relative to its context: the value that the key has behind the range before, within the range.
3. The chunk gets its answers, a byte or two per n-gram and a count per word, and scores its documents whole. A word's own count is its count as a context, for every word is followed by
   one or by the end.

Chunks and shards are about as large as each other and grow with the root of the input, so that the messages between them, at least MESSAGE bytes of text each, grow
in proportion to it. Words that make up more than HOT of a chunk's are dealt over several shards by successor, so no shard grows with one word.
Successors are told apart by 32 bits within their context. Null texts are empty: one token, the end. Repeated rows each count and get a row; extra columns are
ignored; an empty table gives an empty result. A very long text is a chunk of its own, whole.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import keys_of, materialize, mix64, read_table, remainder

DISCOUNT = 0.75
#: Bytes of text in a chunk at least, and for each message between a chunk and a shard.
CHUNK, MESSAGE = 4_000_000, 4096
HOT = 0.004
BEGIN, END = 1, 2  # keys of the marks; words' keys have more bits
LOW32 = np.uint64(0xFFFFFFFF)


#: Ones in a byte, and the place of its k-th one.
POPCOUNT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint8)
PLACE = np.argsort(1 - np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"), axis=1, kind="stable")


class EliasFano:
    """A sorted sequence of integers below 2**63: low bits packed, high bits in unary, with counts of zeros and ones before each 64-bit word."""

    def __init__(self, values: np.ndarray, arena: Arena):
        values = np.asarray(values, np.uint64)
        n = self.n = len(values)
        top = int(values[-1]) + 1 if n else 1
        self.low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        bits = np.zeros(((n + (int(high[-1]) if n else 0) + 1) // 64 + 1) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = bits.reshape(-1, 64).sum(1)
        self.words = arena.put(words)
        self.ones = arena.put(np.r_[0, np.cumsum(ones)].astype(np.int64))
        self.zeros = arena.put(np.r_[0, np.cumsum(64 - ones)].astype(np.int64))
        if self.low_bits:
            each = ((values[:, None] >> np.arange(self.low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8) if n * self.low_bits < 1 << 22 else None
            if each is None:
                parts = [np.packbits((((v[:, None] >> np.arange(self.low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)).ravel(), bitorder="little") for v in np.split(values, range(8192, n, 8192))]
                packed = np.concatenate(parts)  # 8192 values fill whole bytes
            else:
                packed = np.packbits(each.ravel(), bitorder="little")
            self.lows = arena.put(np.r_[packed, np.zeros(16 - len(packed) % 8, np.uint8)].view(np.uint64))

    def _select(self, counts: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the k-th (from 0) one or zero."""
        out = np.empty(len(k), np.int64)
        for a in range(0, len(k), 65536):
            part = k[a : a + 65536]
            word = np.searchsorted(counts, part, "right") - 1
            found = self.words[word] if ones else ~self.words[word]
            rest = (part - counts[word]).astype(np.uint8)
            # the byte that holds it, from the running counts of the word's bytes, then the place in the byte from a table
            octets = found.view(np.uint8).reshape(-1, 8)
            running = np.cumsum(POPCOUNT[octets], 1, dtype=np.uint8)
            byte = (running > rest[:, None]).argmax(1)
            at = np.arange(len(part))
            rest -= np.where(byte > 0, running[at, byte - 1], 0).astype(np.uint8)
            out[a : a + 65536] = 64 * word + 8 * byte + PLACE[octets[at, byte], rest]
        return out

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        left = np.where(shift == 0, np.uint64(0), self.lows[word + 1] << (np.uint64(64) - np.maximum(shift, np.uint64(1))))
        return (self.lows[word] >> shift | left) & np.uint64((1 << self.low_bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        high = self._select(self.ones, i, True) - i
        return high.astype(np.uint64) << np.uint64(self.low_bits) | self._low(i)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each x, or -1: the run of values with its high bits, then a successor search among their low bits."""
        x = np.asarray(x, np.uint64)
        out = np.full(len(x), -1, np.int64)
        if not self.n:
            return out
        high = (x >> np.uint64(self.low_bits)).astype(np.int64)
        inside = np.flatnonzero(high < self.zeros[-1])
        h = high[inside]
        low = np.where(h > 0, self._select(self.zeros, np.maximum(h - 1, 0), False) - h + 1, 0)
        end = np.minimum(self._select(self.zeros, h, False) - h, self.n)
        want = x[inside] & np.uint64((1 << self.low_bits) - 1)
        live = np.flatnonzero(low < end)
        while len(live):  # halve what is left of each run
            mid = (low[live] + end[live]) // 2
            less = self._low(mid) < want[live]
            low[live[less]] = mid[less] + 1
            end[live[~less]] = mid[~less]
            live = live[low[live] < end[live]]
        ok = low < self.n
        ok[ok] = self.access(low[ok]) == x[inside][ok]
        out[inside[ok]] = low[ok]
        return out


class Arena:
    """Arrays in one memory-mapped temporary file without a name, so nothing is left of it."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()  # noqa: SIM115

    def put(self, array: np.ndarray) -> np.ndarray:
        start = self.file.seek(0, 2)
        self.file.write(array.tobytes() or b"\0" * 8)
        self.file.write(b"\0" * (-array.nbytes % 8))
        self.file.flush()
        return np.memmap(self.file, array.dtype, "r", start, (len(array),)) if len(array) else array


#: Steps of an eighth of an octave below one; the last code is for what isn't there.
STEP, ABSENT = 8, 255


def quantise(p: np.ndarray) -> np.ndarray:
    return np.clip(np.round(-STEP * np.log2(np.maximum(p, 1e-30))), 0, ABSENT - 1).astype(np.uint8)


#: The probability of each code.
CODEBOOK = np.r_[2.0 ** (-np.arange(ABSENT) / STEP), 0.0]


class Level:
    """The successors of all nodes of the level above."""

    def __init__(self, owner: np.ndarray, keys: np.ndarray, parents: int, arena: Arena):
        """For each successor, in order, the rank of its parent and its 32-bit key."""
        fan = np.bincount(owner, minlength=parents)
        ends = np.cumsum(fan)
        steps = np.zeros(parents, np.uint64)
        steps[fan > 0] = keys[ends[fan > 0] - 1] + np.uint64(1)
        base = np.cumsum(steps, dtype=np.uint64) - steps
        self.pointers = EliasFano(np.r_[0, ends], arena)
        self.values = EliasFano(base[owner] + keys, arena)

    def find(self, parent: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Rank of each key below its parent (a rank, or -1 for none), or -1."""
        out = np.full(len(keys), -1, np.int64)
        known = np.flatnonzero(parent >= 0)
        if not self.values.n or not len(known):
            return out
        # keys that follow each other mostly have one parent
        heads = np.flatnonzero(np.r_[True, np.diff(parent[known]) != 0])
        size = np.diff(np.r_[heads, len(known)])
        begin, end = (self.pointers.access(parent[known][heads] + k).astype(np.int64) for k in (0, 1))
        before = np.where(begin > 0, self.values.access(np.maximum(begin - 1, 0)) + np.uint64(1), np.uint64(0))
        found = self.values.find(np.repeat(before, size) + keys[known])
        out[known] = np.where((found >= np.repeat(begin, size)) & (found < np.repeat(end, size)), found, -1)
        return out


class Trie:
    """Words with exact counts, their successors and those of these, with quantised f, and b of what has successors."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray, n2: np.ndarray, triples: np.ndarray, n3: np.ndarray, discount: float = DISCOUNT):
        """Sorted keys; pairs: place of the word and key of its successor; triples: place of the pair and key of its successor; training counts."""
        arena = Arena()
        owner2, owner3 = ((x >> np.uint64(32)).astype(np.int64) for x in (pairs, triples))
        c1, c2 = np.bincount(owner2, n2, len(words)), np.bincount(owner3, n3, len(pairs))
        seen1, seen2, seen3 = c1 > 0, n2 > 0, n3 > 0
        rank1, rank2 = np.cumsum(seen1) - 1, np.cumsum(seen2) - 1
        back = lambda owner, seen, c: np.where(c > 0, quantise(discount * np.bincount(owner[seen], minlength=len(c)) / np.maximum(c, 1)), ABSENT).astype(np.uint8)
        self.level1 = EliasFano(words[seen1] >> np.uint64(1), arena)
        self.counts, self.back1 = arena.put(c1[seen1].astype(np.int64)), arena.put(back(owner2, seen2, c1)[seen1])
        self.level2 = Level(rank1[owner2[seen2]], pairs[seen2] & LOW32, int(seen1.sum()), arena)
        self.f2, self.back2 = arena.put(quantise((n2 - discount)[seen2] / c1[owner2[seen2]])), arena.put(back(owner3, seen3, c2)[seen2])
        self.level3 = Level(rank2[owner3[seen3]], triples[seen3] & LOW32, int(seen2.sum()), arena)
        self.f3 = arena.put(quantise((n3 - discount)[seen3] / c2[owner3[seen3]]))

    def lookup(self, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray) -> tuple[np.ndarray, ...]:
        """Counts and b of words, f and b of pairs, f of triples; what isn't there has count 0 and ABSENT."""
        at = lambda array, i, none: np.where(i >= 0, array[np.maximum(i, 0)], none).astype(array.dtype) if len(array) else np.full(len(i), none, array.dtype)
        r1 = self.level1.find(words >> np.uint64(1))
        r2 = self.level2.find(r1[(pairs >> np.uint64(32)).astype(np.int64)], pairs & LOW32)
        r3 = self.level3.find(r2[(triples >> np.uint64(32)).astype(np.int64)], triples & LOW32)
        return at(self.counts, r1, 0), at(self.back1, r1, ABSENT), at(self.f2, r2, ABSENT), at(self.back2, r2, ABSENT), at(self.f3, r3, ABSENT)


def narrow(x: np.ndarray) -> list[np.ndarray]:
    """Small numbers as bytes, with places and values of those that aren't."""
    large = np.flatnonzero(x >= 255)
    return [np.minimum(x, 255).astype(np.uint8), large.astype(np.uint32), x[large].astype(np.uint32)]


NARROW = (np.uint8, np.uint32, np.uint32)


def widen(small: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
    out = small.astype(np.int64)
    out[place] = value
    return out


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one blob; lengths in front."""
    parts = [a.tobytes() for a in arrays]
    return np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(parts)


def unpack(blob: bytes, *types) -> list[np.ndarray]:
    lengths = np.frombuffer(blob, np.int64, len(types))
    ends = 8 * len(types) + np.cumsum(lengths)
    return [np.frombuffer(blob[e - n : e], t) for e, n, t in zip(ends, lengths, types)]


REQUEST = (np.uint64, *NARROW, np.uint32, *NARROW, *NARROW, np.uint32, *NARROW)
ANSWER = (np.uint32, np.uint8, np.uint8, np.uint8, np.uint8)


def tokens(text: str | None) -> np.ndarray:
    return keys_of((text or "").encode("utf-8", "surrogatepass").lower().split())


def ngrams(texts: list[str | None], train: np.ndarray) -> dict[str, np.ndarray]:
    """Distinct words, pairs and triples of a chunk, nested, and each token's place in them."""
    rows = [np.r_[np.uint64(BEGIN), tokens(t), np.uint64(END)] for t in texts]
    lengths = np.array([len(r) - 1 for r in rows], np.int64)
    flat = np.concatenate(rows)
    last = np.zeros(len(flat), bool)
    last[np.cumsum(lengths + 1) - 1] = True
    doc = np.repeat(np.arange(len(rows)), lengths)
    w = flat[1:][~last[:-1]]
    key = w >> np.uint64(32) ^ w & LOW32
    words, word = np.unique(flat[~last], return_inverse=True)  # a word is the next pair's first, and the end nobody's
    pairs, pair = np.unique(word.astype(np.uint64) << np.uint64(32) | key, return_inverse=True)
    second = np.flatnonzero(doc[1:] == doc[:-1]) + 1  # tokens behind another one of their text
    triples, triple = np.unique(pair[second - 1].astype(np.uint64) << np.uint64(32) | key[second], return_inverse=True)
    learned = train[doc]
    return {
        "lengths": lengths, "doc": doc, "words": words, "word": word, "pair": pair, "second": second, "triple": triple,
        "owner2": (pairs >> np.uint64(32)).astype(np.int64), "key2": (pairs & LOW32).astype(np.uint32), "n2": np.bincount(pair[learned], minlength=len(pairs)),
        "owner3": (triples >> np.uint64(32)).astype(np.int64), "key3": (triples & LOW32).astype(np.uint32), "n3": np.bincount(triple[learned[second]], minlength=len(triples)),
    }


def routes(b: dict[str, np.ndarray], hot: dict[int, int], shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(shard, words, fan, pairs, triples): places in b of what goes to each shard, and how many of the pairs belong to each word. A hot word goes to all its shards, its pairs to one each."""
    keys = b["words"]
    spread = np.ones(len(keys), np.int64)
    for key, n in hot.items():
        at = np.searchsorted(keys, np.uint64(key))
        if at < len(keys) and keys[at] == key:
            spread[at] = min(shards, n)
    start = np.cumsum(spread) - spread
    entry = np.repeat(np.arange(len(keys)), spread)
    entry_shard = ((mix64(keys) % np.uint64(shards)).astype(np.int64)[entry] + np.arange(len(entry)) - start[entry]) % shards
    entry_of_pair = start[b["owner2"]] + (mix64(b["key2"].astype(np.uint64)) % spread[b["owner2"]].astype(np.uint64)).astype(np.int64)
    fan = np.bincount(entry_of_pair, minlength=len(entry))
    small = np.uint16 if shards < 1 << 16 else np.int64  # 16 bits are sorted by radix
    pair_shard = entry_shard[entry_of_pair].astype(small)
    triple_shard = pair_shard[b["owner3"]]
    (e, cut_e), (p, cut_p), (t, cut_t) = ((np.argsort(x, kind="stable"), np.r_[0, np.cumsum(np.bincount(x, minlength=shards))]) for x in (entry_shard.astype(small), pair_shard, triple_shard))
    for s in range(shards):
        entries = e[cut_e[s] : cut_e[s + 1]]
        if len(entries):
            yield s, entry[entries], fan[entries], p[cut_p[s] : cut_p[s + 1]], t[cut_t[s] : cut_t[s + 1]]


def requests(b: dict[str, np.ndarray], hot: dict[int, int], shards: int) -> Iterator[tuple[int, bytes]]:
    fan2 = np.bincount(b["owner3"], minlength=len(b["owner2"]))
    for s, words, fan, pairs, triples in routes(b, hot, shards):
        yield s, pack(b["words"][words], *narrow(fan), b["key2"][pairs], *narrow(b["n2"][pairs]), *narrow(fan2[pairs]), b["key3"][triples], *narrow(b["n3"][triples]))


def build_and_answer(blobs: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """One shard: answers to requests, and its words with their training counts."""
    asked = [unpack(blob, *REQUEST) for blob in blobs]
    join = lambda k: np.concatenate([a[k] for a in asked])
    wide = lambda k: np.concatenate([widen(*a[k : k + 3]) for a in asked])
    words, word = np.unique(join(0), return_inverse=True)
    pairs, pair = np.unique(np.repeat(word, wide(1)).astype(np.uint64) << np.uint64(32) | join(4), return_inverse=True)
    triples, triple = np.unique(np.repeat(pair, wide(8)).astype(np.uint64) << np.uint64(32) | join(11), return_inverse=True)
    n2, n3 = np.bincount(pair, wide(5), len(pairs)), np.bincount(triple, wide(12), len(triples))
    found = Trie(words, pairs, n2, triples, n3).lookup(words, pairs, triples)
    count, back1 = (x[word] for x in found[:2])
    f2, back2 = (x[pair] for x in found[2:4])
    f3 = found[4][triple]
    cuts = [np.r_[0, np.cumsum([len(a[k]) for a in asked])] for k in (0, 4, 11)]
    part = lambda x, k, i: x[cuts[k][i] : cuts[k][i + 1]]
    answers = [pack(part(count, 0, i).astype(np.uint32), part(back1, 0, i), part(f2, 1, i), part(back2, 1, i), part(f3, 2, i)) for i in range(len(blobs))]
    return answers, words, found[0]


def score_chunk(b: dict[str, np.ndarray], answers: dict[int, bytes], hot: dict[int, int], shards: int, n: int, v: int) -> dict[str, np.ndarray]:
    count, back1 = np.zeros(len(b["words"])), np.zeros(len(b["words"]))
    f2, back2, f3 = np.zeros(len(b["owner2"])), np.ones(len(b["owner2"])), np.zeros(len(b["owner3"]))
    for s, words, fan, pairs, triples in routes(b, hot, shards):
        c, b1, p2, b2, p3 = unpack(answers[s], *ANSWER)
        # the shards of a hot word know f and b by their own parts of its count
        count[words] += c
        back1[words] += c * CODEBOOK[b1]
        f2[pairs] = CODEBOOK[p2] * np.repeat(c, fan)
        back2[pairs] = np.where(b2 == ABSENT, 1.0, CODEBOOK[b2])
        f3[triples] = CODEBOOK[p3]
    seen = np.maximum(count, 1)
    back1, f2 = np.where(count > 0, back1 / seen, 1.0), f2 / seen[b["owner2"]]
    begin = count[np.searchsorted(b["words"], BEGIN)]
    # the end occurs as often as the beginning
    is_end = np.zeros(len(b["doc"]), bool)
    is_end[np.cumsum(b["lengths"]) - 1] = True
    c_w = np.where(is_end, begin, count[np.r_[b["word"][1:], 0]])
    unigram = (c_w + 1) / (n + v + 1)
    p = f2[b["pair"]] + back1[b["word"]] * unigram
    second = b["second"]
    p[second] = f3[b["triple"]] + back2[b["pair"][second - 1]] * p[second]
    add = lambda x: np.bincount(b["doc"], x, len(b["lengths"]))
    return {"n_tokens": b["lengths"], "n_known": add(c_w > 0).astype(np.int64), "base_score": add(np.log10(unigram)), "score": add(np.log10(p))}


def to_blob(batch: pa.RecordBatch | pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
        out.write(batch)
    return sink.getvalue().to_pybytes()


def from_blob(blob: bytes) -> tuple[list[int | None], np.ndarray, list[str]]:
    """Ids, which are held out, and texts of a chunk."""
    table = pa.ipc.open_stream(blob).read_all()
    return table.column(0).to_pylist(), table.column(1).to_numpy(zero_copy_only=False).astype(bool), table.column(2).to_pylist()


def packed(chunk_bytes: int):
    """Chunks of documents as one row each, with the words above HOT of each, and under key 0 all words."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, held, size = 0, [], 0

        def chunk() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            keys = np.concatenate([tokens(t) for t in table.column(2).to_pylist()])
            found, n = np.unique(keys, return_inverse=False, return_counts=True)
            top = n > max(20, HOT * len(keys))
            name = TaskContext.get().partitionId() << 24 | made
            columns = [pa.array([name], pa.int64()), pa.array([to_blob(table.combine_chunks())]), pa.array([np.r_[found[top].view(np.int64), 0].tolist()], pa.list_(pa.int64())), pa.array([np.r_[n[top], len(keys)].tolist()], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, names=["chunk", "docs", "often", "times"])

        for batch in batches:
            # batches are small, but for very long texts: a chunk is full when it has its bytes
            for i in range(0, batch.num_rows, 50):
                part = batch.slice(i, 50)
                held.append(part)
                size += sum(map(len, part.column(2).to_pylist()))
                if size >= chunk_bytes:
                    yield chunk()
                    made, held, size = made + 1, [], 0
        if held:
            yield chunk()

    return step


def score(docs: DataFrame, chunk_bytes: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. chunk_bytes: of a chunk, if not by the size of all texts."""
    held_out = (remainder(F.col("doc_id"), 7) == 2).alias("held_out")
    rows = docs.select("doc_id", held_out, F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.count_if(~F.col("held_out")).alias("train"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("size")).first()
    chunk_bytes = chunk_bytes or max(CHUNK, int((total["size"] * MESSAGE) ** 0.5))
    shards = 1 + total["size"] // chunk_bytes
    chunks = materialize(rows.mapInArrow(packed(chunk_bytes), "chunk long, docs binary, often array<long>, times array<long>"), "lm-chunks")
    # at most 1 / HOT words pass in a chunk; of all that passed in one, those that matter over the whole are kept, at most 1 / HOT again
    often = chunks.select(F.explode(F.arrays_zip("often", "times")).alias("x")).groupBy(F.col("x.often").alias("key")).agg(F.sum("x.times").alias("n"))
    words = (often.where("key = 0").select("n").first() or [0])[0]
    top = often.where((F.col("key") != 0) & (F.col("n") > HOT * words)).collect()
    hot = {int(np.int64(r["key"]).view(np.uint64)): 1 + int(2 * shards * r["n"] / max(1, words)) for r in top}
    hot[BEGIN] = 1 + shards // 50

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                _, out, texts = from_blob(blob.as_py())
                found = list(requests(ngrams(texts, ~out), hot, shards))
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.int32()), pa.array([chunk] * len(found), pa.int64()), pa.array([r for _, r in found], pa.binary())], names=["shard", "chunk", "request"])

    def answer(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        replies, keys, counts = build_and_answer(list(group["request"]))
        split = np.array([int(k) in hot for k in keys.tolist()])
        frame = pd.DataFrame({"chunk": group["chunk"].to_numpy(), "shard": int(key[0]), "answer": replies, "tokens": 0, "words": 0})
        frame.loc[0, ["tokens", "words"]] = [int(counts[keys != BEGIN].sum()), int((counts[~split] > 0).sum())]
        # a hot word counts once: the rows of all its shards that have it in training are joined below
        seen_hot = [(-1, int(key[0]), int(k).to_bytes(8, "little"), 0, 0) for k, t in zip(keys[split].tolist(), counts[split]) if t > 0 and k != BEGIN]
        return pd.concat([frame, pd.DataFrame(seen_hot, columns=frame.columns)]) if seen_hot else frame

    asked = chunks.select("chunk", "docs").mapInArrow(ask, "shard int, chunk long, request binary")
    answered = materialize(asked.groupBy("shard").applyInPandas(answer, "chunk long, shard int, answer binary, tokens long, words long"), "lm-answers")
    sums = answered.agg(F.sum("tokens"), F.sum("words"), F.count_distinct(F.when(F.col("chunk") == -1, F.col("answer")))).first()
    n = int(sums[0] or 0) + total["train"]
    v = int(sums[1] or 0) + int(sums[2]) + (total["train"] > 0)

    def finish(key: tuple, group: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if group.empty:
            return pd.DataFrame({"doc_id": [], "held_out": [], "n_tokens": [], "n_known": [], "train_tokens": [], "base_score": [], "score": []})
        ids, out, texts = from_blob(group["docs"].iat[0])
        found = score_chunk(ngrams(texts, ~out), dict(zip(answers["shard"], answers["answer"])), hot, shards, n, v)
        return pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "held_out": out, "train_tokens": n} | found)

    replies = answered.where("chunk >= 0").select("chunk", "shard", "answer")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return chunks.select("chunk", "docs").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInPandas(finish, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))
