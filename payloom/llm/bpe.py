"""BPE encoding and decoding by tree concatenation.

A text longer than `leaf` code points is halved, wherever that is, down to leaves; leaves are cut into words, and at each join a window around it is cut anew: it reaches
`agree` words to either side and doubles until, on both sides, its words agree with the halves' words at equal places. Then the window is spliced in; one that
has reached both ends is the whole. So the cut of one long text is that of many short ones, whatever stands at the joins.

The words of all texts of a batch that aren't remembered go to the library in one call, which encodes them in parallel on as many threads as it is allowed (the tokenizer carries no
token across words). A word longer than `leaf` is the root of a tree of its own, for its encoding depends on all of it: halves are encoded, and a window of
`grow` tokens to either side of the join is encoded anew and doubles until, on both sides, the new tokens agree with the halves' on a stretch of `agree` tokens at equal
offsets. All such trees grow at once: their leaves are one call of the library, and so are the windows of a level.

Null and empty texts have no tokens. Repeated rows get repeated results, extra columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Generator, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from payloom.llm.common import read_table

#: Longest text that is cut whole, and longest word that goes to the library whole, in code points.
LEAF = 2048
#: Pieces, and split words, that a Python worker remembers at most, twice over.
REMEMBERED = 250_000

#: In a text of these characters letters are lower-cased and words are split here as the library does it (a letter, number or
#: sign there is one here, too, and nothing composes), so words are looked up one by one.
PLAIN = re.compile("[\t\n\r !-~\u00a1-\u00ff]*").fullmatch
WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff]+|[0-9\u00b2\u00b3\u00b9\u00bc-\u00be]|[^a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u00ff0-9\u00b2\u00b3\u00b9\u00bc-\u00be\\s]+").findall


def pieces(text: str) -> list[str]:
    """What spaces part, of other texts: the tokenizer's normaliser and splitter never carry a token across them."""
    return [p for p in text.split(" ") if p]


#: In the tokenizer's description: what is split off, with white space in no token.
DROPS_SPACE = r"|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


class Memory(dict):
    """A dict in two generations: when the young one is full, it becomes the old one; what is used again moves up."""

    def __init__(self, most: int):
        self.most, self.old = most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is not None:
            self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


#: Asks for lists of texts, is sent their encodings, and returns its own.
Asking = Generator[list[str], list[tuple], tuple]


def together(askers: list[Asking]) -> Generator[list[str], list[tuple], list[tuple]]:
    """Several askers as one: what they ask for in a round is asked for at once."""
    results: list[tuple] = [()] * len(askers)
    waiting = [(i, a, next(a)) for i, a in enumerate(askers)]
    while waiting:
        answers = iter((yield [t for *_, texts in waiting for t in texts]))
        following = []
        for i, a, texts in waiting:
            try:
                following.append((i, a, a.send([next(answers) for _ in texts])))
            except StopIteration as done:
                results[i] = done.value
        waiting = following
    return results


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class TreeEncoder:
    """Encodes like the library's encode(text, add_special_tokens=False)."""

    def __init__(self, path: str, leaf: int = LEAF, grow: int = 64, agree: int = 8):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        if DROPS_SPACE not in self.tok.to_str():
            raise ValueError(f"{path} isn't a tokenizer that drops white space and splits words in the known way")
        self.tok.no_truncation()
        self.tok.no_padding()
        self.leaf, self.grow, self.agree = leaf, grow, agree
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known, self.words = Memory(REMEMBERED), Memory(REMEMBERED)
        self.names: dict[int, str] = {}
        self.cuts = self.joins = self.rounds = 0  # joins of texts and of words, and calls of the library for the latter
        self.decoder = self.tok.decoder

    def trees(self, texts: list[str]) -> list[tuple[list[int], list[tuple[int, int]]]]:
        """Ids and offsets of pieces without white space, however long. What all of them ask for next is one batch."""
        found = together([self._tree(t) for t in texts])
        try:
            asked = next(found)
            while True:
                self.rounds += 1
                asked = found.send([(e.ids, e.offsets) for e in self.tok.encode_batch(asked, add_special_tokens=False)])
        except StopIteration as done:
            return done.value

    def _tree(self, text: str) -> Asking:
        if len(text) <= self.leaf:
            return (yield [text])[0]
        mid = len(text) // 2
        left, right = yield from together([self._tree(text[:mid]), self._tree(text[mid:])])
        return (yield from self._join(text, mid, left, right))

    def _join(self, text: str, mid: int, left: tuple, right: tuple) -> Asking:
        self.joins += 1
        ids_l, off_l = left
        ids_r, off_r = right[0], [(a + mid, b + mid) for a, b in right[1]]
        reach = self.grow
        while True:
            i, j = max(0, len(ids_l) - reach), min(len(ids_r), reach)
            lo = off_l[i][0] if i else 0
            hi = off_r[j - 1][1] if j < len(ids_r) else len(text)
            ((ids, off),) = yield [text[lo:hi]]
            if lo == 0 and hi == len(text):
                return ids, off
            off = [(a + lo, b + lo) for a, b in off]
            cut_l = self._agreement(ids, off, ids_l, off_l, i, front=True) if i else 0
            cut_r = self._agreement(ids, off, ids_r, off_r, j, front=False) if j < len(ids_r) else 0
            if cut_l is not None and cut_r is not None:
                (a, b), (c, d) = (cut_l or (i, 0)), (cut_r or (j, len(ids)))
                if b <= d:
                    return ids_l[:a] + ids[b:d] + ids_r[c:], off_l[:a] + off[b:d] + off_r[c:]
            reach *= 2

    def _agreement(self, ids, off, ids_h, off_h, at: int, front: bool) -> tuple[int, int] | None:
        """(index in the half, index in the window) of a stretch of equal tokens at equal places, strictly inside the half."""
        n = self.agree
        place = {o: k for k, o in enumerate(off)}
        steps = range(at, len(ids_h) - n) if front else range(at - n - 1, -1, -1)
        for k in steps:
            w = place.get(off_h[k])
            if w is not None and ids[w : w + n] == ids_h[k : k + n] and off[w : w + n] == off_h[k : k + n] and len(ids[w : w + n]) == n:
                return (k + n // 2, w + n // 2)
        return None

    def cut(self, text: str, words: Callable[[str], list[str]]) -> list[str]:
        """words(text), by halves. Between words, which hold none of it, there is white space only."""
        if len(text) <= self.leaf:
            return words(text)
        mid = len(text) // 2
        left, right = self.cut(text[:mid], words), self.cut(text[mid:], words)
        self.cuts += 1
        reach = self.agree
        while True:
            low, high = 0, len(text)
            if reach < len(left):
                low = mid
                for w in reversed(left[-reach:]):
                    low = text.rindex(w, 0, low)
            if reach < len(right):
                high = mid
                for w in right[:reach]:
                    high = text.index(w, high) + len(w)
            window = words(text[low:high])
            if low == 0 and high == len(text):
                return window
            # a window begins and ends where a word of a half does, so equal words there are at equal places
            inside = reach // 2
            if (low == 0 or window[:inside] == left[-reach:][:inside]) and (high == len(text) or window[-inside:] == right[:reach][-inside:]):
                return (left[:-reach] if low else []) + window + (right[reach:] if high < len(text) else [])
            reach *= 2

    def _fill(self, memory: Memory, fresh: list[str], one) -> dict[str, bytes]:
        """Encode what the memory lacks; what is longer than a leaf goes through the tree and isn't remembered."""
        short = [w for w in fresh if len(w) <= self.leaf]
        got = dict(zip(short, one(short)))
        memory.update(got)
        if long := [w for w in fresh if len(w) > self.leaf]:
            got.update((w, packed(ids)) for w, (ids, _) in zip(long, self.trees(long)))
        return got

    def _pieces(self, short: list[str]) -> list[bytes]:
        return [packed(e.ids) for e in self.tok.encode_batch_fast(short, add_special_tokens=False)]

    def _words(self, short: list[str]) -> list[bytes]:
        """Words that need no normalising or splitting, many to a call."""
        out: list[bytes] = []
        for e in self.bare.encode_batch([short[i : i + 200] for i in range(0, len(short), 200)], is_pretokenized=True, add_special_tokens=False):
            ids, ends = packed(e.ids), [0]
            words = e.word_ids
            ends += [k for k in range(1, len(words)) if words[k] != words[k - 1]] + [len(words)]
            out += [ids[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, each as little-endian unsigned 32-bit integers."""
        plain = [bool(PLAIN(t)) and "<|" not in t for t in texts]
        cut = [self.cut(t.lower(), WORDS) if p else self.cut(t.replace("\n", " "), pieces) for t, p in zip(texts, plain)]
        lists: list[list] = []
        fresh: tuple[set, set] = (set(), set())
        for ws, p in zip(cut, plain):
            memory = self.words if p else self.known
            lists.append(xs := [memory[w] for w in ws])
            if None in xs:
                fresh[p].update([w for w, x in zip(ws, xs) if x is None])
        got = self._fill(self.known, list(fresh[0]), self._pieces), self._fill(self.words, list(fresh[1]), self._words)
        out = [b"".join([got[p][w] if x is None else x for w, x in zip(ws, xs)] if None in xs else xs) for ws, xs, p in zip(cut, lists, plain)]
        self.known.turn()
        self.words.turn()
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_batch([text or ""])[0]

    def decode(self, ids: bytes) -> str:
        """As the library's decode(ids, skip_special_tokens=False): without a decoder it joins tokens by spaces."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        if self.decoder is not None:
            return self.tok.decode(numbers, skip_special_tokens=False)
        names = self.names
        if not names:
            names.update((i, w) for w, i in self.tok.get_vocab(with_added_tokens=True).items())
        return " ".join([names[i] for i in numbers])


_ENCODERS: dict[str, TreeEncoder] = {}


def encoder(path: str) -> TreeEncoder:
    """One per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TreeEncoder(path)
    return _ENCODERS[path]


def encode_documents(docs: DataFrame, path: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded with keep_ids)."""
    path = path or default_path()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = enc.encode_batch(texts)
            back = [enc.decode(i) for i in ids]
            columns = [
                batch.column(0),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array([np.frombuffer(i, "<u4").astype("i4").tolist() for i in ids], pa.list_(pa.int32())), pa.array(back)]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    more = ", ids array<int>, decoded string" if keep_ids else ""
    return docs.select("doc_id", "text").mapInArrow(step, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + more)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"))
