"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

The features are densities of learned lexicon words and word beginnings, hits near a second-person word, hits after common
letter substitutions are undone, and rates of capitals, punctuation and obfuscated words. A bounded, hash-ordered sample of labelled training rows
(PER_CLASS of each class) is dealt into three parts: one fits the lexicon, one the trees, one the calibration, where classes weigh as
they occur in all labelled training rows. Every text is scored whole.

Null and empty texts get the score of a text without any hit. Without labels of both classes every score is the share of toxic labels, or 0.
Repeated rows each get a score; extra columns are ignored; an empty table gives an empty result. Texts may be of any length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import read_table, remainder
from payloom.llm.models import Boosted, Isotonic, sample_labels

#: Labelled rows of each class that a model is fitted on, at most.
PER_CLASS = 4000
#: Lexicon entries must occur in as many toxic texts of the lexicon's part of the sample, and in few others.
LEAST, CLEAN_SHARE = 8, 0.05
#: The sample is dealt into PARTS: those below LEXICON fit the lexicon, those from CALIBRATION on the calibration, the rest the trees.
PARTS, LEXICON, CALIBRATION = 20, 9, 16
#: Lengths of word beginnings in the lexicon.
STEMS = (4, 5)

SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch ihr tu te toi vous votre vos ton ta tes tú ti usted ustedes vosotros su tus".split())
UNDO = str.maketrans("013457@$!*", "oieastasii")
WORDS = re.compile(r"[^\W\d_]+").findall
OBFUSCATED = re.compile(r"\b[^\W\d_]+[0-9@$!*]+[^\W\d_]+").findall
CAPITALS = re.compile(r"[A-Z]").findall
SIGNS = re.compile(r"[!?]").findall
PUNCTUATION = re.compile(r"[^\w\s]").findall


def keys(text: str) -> tuple[set[str], set[str]]:
    """Distinct words of a text, and their beginnings."""
    words = set(WORDS(text.lower()))
    return words, {w[:n] for w in words for n in STEMS if len(w) >= n}


def telling(toxic: int, clean: int, share: float) -> bool:
    """Whether an entry occurs in enough toxic texts and in few others; share: toxic texts for each other one."""
    return toxic >= LEAST and clean * share <= CLEAN_SHARE * toxic


@dataclass
class Lexicon:
    words: frozenset[str]
    stems: frozenset[str]

    @classmethod
    def fit(cls, texts: list[str], y: np.ndarray) -> Lexicon:
        share = max(1, int(y.sum())) / max(1, len(y) - int(y.sum()))
        found = []
        for kind in (0, 1):
            toxic, clean = Counter(), Counter()
            for t, label in zip(texts, y):
                (toxic if label else clean).update(keys(t)[kind])
            found.append(frozenset(k for k, n in toxic.items() if telling(n, clean[k], share)))
        return cls(*found)

    def features(self, text: str) -> tuple[float, ...]:
        words = WORDS(text.lower())
        n, chars = max(1, len(words)), max(1, len(text))
        hits = [i for i, w in enumerate(words) if w in self.words]
        stems = sum([w[:4] in self.stems or w[:5] in self.stems for w in words])
        near = sum(any(w in SECOND_PERSON for w in words[max(0, i - 4) : i + 5]) for i in hits)
        odd = OBFUSCATED(text)
        undone = sum(w in self.words or w[:5] in self.stems for w in (o.lower().translate(UNDO) for o in odd))
        return (
            len(hits),
            stems,
            1000 * len(hits) / n,
            1000 * stems / n,
            near,
            undone,
            1000 * len(odd) / n,
            len(CAPITALS(text)) / chars,
            1000 * len(SIGNS(text)) / chars,
            100 * len(PUNCTUATION(text)) / chars,
            np.log1p(n),
        )


def part_of(doc_id: int) -> int:
    return crc32(f"part{doc_id}".encode()) % PARTS


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: Boosted | None
    calibrate: Isotonic
    prior: float

    @classmethod
    def fit(cls, lexicon: Lexicon, rows: list[tuple[int, int, list[float]]], counts: dict[int, int]) -> ToxicityModel:
        """rows: doc_id, label and features of the sample but for the lexicon's part; counts: labels of all training rows."""
        total = sum(counts.values())
        prior = counts.get(1, 0) / total if total else 0.0
        rows = sorted(rows, key=lambda r: (crc32(f"part{r[0]}".encode()), r[0], r[2]))
        part, y = np.array([part_of(r[0]) for r in rows]), np.array([r[1] for r in rows], int)
        rest, last = part < CALIBRATION, part >= CALIBRATION
        if not len(y) or min(np.bincount(y[m], minlength=2).min() for m in (rest, last)) < 5:
            return cls(lexicon, None, Isotonic(), prior)
        weight = np.where(y == 1, counts.get(1, 0) / max(1, y.sum()), counts.get(0, 0) / max(1, (1 - y).sum()))
        x = np.array([r[2] for r in rows])
        trees = Boosted.fit(x[rest], y[rest].astype(float), np.ones(rest.sum()))
        return cls(lexicon, trees, Isotonic.fit(trees(x[last]), y[last].astype(float), weight[last]), prior)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None or not texts:
            return np.full(len(texts), self.prior)
        return np.clip(self.calibrate(self.trees(np.array([self.lexicon.features(t or "") for t in texts]))), 0, 1)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ToxicityModel:
    """Only counts of words and rows of features come to the driver, so its memory is bounded whatever the texts' length."""
    chosen, counts = sample_labels(labels, "toxic", remainder(F.col("doc_id"), 5) != 0, per_class)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", F.coalesce("text", F.lit("")).alias("text"))
    part = F.crc32(F.concat(F.lit("part"), F.col("doc_id").cast("string"))) % PARTS

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(kind, k, y) for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for kind, ks in enumerate(keys(text)) for k in ks]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int32()))], names=["kind", "k", "y"])

    first = sample.where(part < LEXICON)
    sizes = {r["y"]: r["n"] for r in first.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = max(1, sizes.get(1, 0)) / max(1, sizes.get(0, 0))
    seen = first.select("y", "text").mapInArrow(entries, "kind int, k string, y int").groupBy("kind", "k").agg(F.sum("y").alias("toxic"), F.count_if(F.col("y") == 0).alias("clean"))
    told = seen.where((F.col("toxic") >= LEAST) & (F.col("clean") * share <= CLEAN_SHARE * F.col("toxic"))).collect()
    lexicon = Lexicon(*(frozenset(r["k"] for r in told if r["kind"] == kind) for kind in (0, 1)))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [list(map(float, lexicon.features(t))) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    rows = sample.where(part >= LEXICON).mapInArrow(features, "doc_id long, y int, x array<double>").collect()
    return ToxicityModel.fit(lexicon, [tuple(r) for r in rows], counts)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = shared.value.scores(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype("i4"))], names=["doc_id", "held_out", "score", "predicted"])

    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return docs.select("doc_id", held_out, "text").mapInArrow(step, "doc_id long, held_out boolean, score double, predicted int")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
