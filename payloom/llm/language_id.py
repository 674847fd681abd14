"""Language identification by nearest centroids.

A text is a bag of byte trigrams of its letters (ASCII lower-cased, anything else one space), hashed into DIMENSIONS buckets. Its vector
is the logarithm of the counts times inverse document frequency, normalised. Each language has several centroids, clustered with
spherical k-means; the nearest centroid by cosine wins. A text farther from it than nearly all of that language's sample is
marked as rejected, while the nearest language is still reported.

Document frequencies are counted over all training documents. The clusters are fitted on a bounded sample (SAMPLE documents, dealt
evenly over all languages by hash, one of each at least), of which trigram counts, not texts, come to the driver. Null texts and texts without letters are `und` with score 0. Without a training document all are `und`.
Repeated rows each count and get a row; further columns are ignored; an empty table gives an empty result. Texts may be of any length; equal distances go to the first centroid.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payloom.llm.common import read_table, remainder

DIMENSIONS = 4096
#: Documents that clusters are fitted on, about this many, but one of each language at least.
SAMPLE = 3000
CLUSTERS = 3
#: Bytes that go through the counter at once.
BLOCK = 1 << 22
LETTER = re.compile(r"[^\W\d_]").search

_TABLE = np.full(256, 32, np.uint8)
_TABLE[97:123] = np.arange(97, 123)
_TABLE[65:91] = np.arange(97, 123)
_TABLE[128:] = np.arange(128, 256)


def counts(texts: list[str | None]) -> np.ndarray:
    """Trigram counts of whole texts, one row each."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    start = 0
    data = [(" " + (t or "") + "  ").encode("utf-8", "replace") for t in texts]
    while start < len(data):
        end, size = start + 1, len(data[start])
        while end < len(data) and size + len(data[end]) <= BLOCK:
            size += len(data[end])
            end += 1
        x = _TABLE[np.frombuffer(b"".join(data[start:end]), np.uint8)].astype(np.uint32)
        h = ((x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA77)) ^ (x[2:] * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F)
        places = (h >> np.uint32(32 - 12)).astype(np.int64)
        lengths = np.array([len(d) for d in data[start:end]])
        owner = np.repeat(np.arange(end - start), lengths)[:-2]
        blank = (x[:-2] == 32) & (x[1:-1] == 32) | (x[1:-1] == 32) & (x[2:] == 32)
        keep = ~blank
        out[start:end] = np.bincount(owner[keep] * DIMENSIONS + places[keep], minlength=(end - start) * DIMENSIONS).reshape(-1, DIMENSIONS)
        start = end
    return out


def normalised(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


@dataclass
class Centroids:
    languages: list[str]
    idf: np.ndarray
    centres: np.ndarray
    owner: np.ndarray  # index of each centre's language
    radius: np.ndarray  # largest usual distance, by centre

    def vectors(self, texts: list[str | None]) -> np.ndarray:
        return normalised(np.log1p(counts(texts)) * self.idf)

    @classmethod
    def fit(cls, sample: list[tuple[str, np.ndarray]], idf: np.ndarray, clusters: int = CLUSTERS) -> Centroids:
        """sample: (language, trigram counts)."""
        model = cls(sorted({lang for lang, _ in sample}), idf.astype(np.float32), np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, int), np.zeros(0))
        centres, owner, radius = [], [], []
        for i, lang in enumerate(model.languages):
            x = normalised(np.log1p(np.stack([n for other, n in sample if other == lang])) * model.idf)
            c = x[:1]
            while len(c) < min(clusters, len(x)):  # the farthest point from those chosen
                c = np.vstack([c, x[(x @ c.T).max(1).argmin()][None]])
            for _ in range(10):
                near = (x @ c.T).argmax(1)
                c = normalised(np.vstack([x[near == k].sum(0) if (near == k).any() else c[k] for k in range(len(c))]))
            near, cosine = (x @ c.T).argmax(1), (x @ c.T).max(1)
            for k in range(len(c)):
                mine = cosine[near == k]
                centres.append(c[k])
                owner.append(i)
                radius.append(1 - np.quantile(mine, 0.005) if len(mine) else 1.0)
        if centres:
            model.centres, model.owner, model.radius = np.array(centres, np.float32), np.array(owner), np.array(radius)
        return model

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and rejection of each text."""
        letters = np.array([bool(t) and LETTER(t) is not None for t in texts], bool)
        if not self.languages or not letters.any():
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = self.vectors(texts) @ self.centres.T
        best = cosine.argmax(1)
        top = np.where(letters, np.clip(cosine.max(1), 0, 1), 0)
        names = [self.languages[self.owner[b]] if ok else "und" for b, ok in zip(best, letters)]
        return names, top.astype(float), ~letters | (1 - top > self.radius[best])


def fit(docs: DataFrame, sample: int = SAMPLE) -> Centroids:
    """Learn from text and non-null lang of documents whose remainder modulo 5 isn't 0."""
    train = docs.where((remainder(F.col("doc_id"), 5) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(DIMENSIONS, np.int64), 0
        langs: dict[str, int] = {}
        for batch in batches:
            total += (counts(batch.column(1).to_pylist()) > 0).sum(0)
            n += batch.num_rows
            for lang in batch.column(0).to_pylist():
                langs[lang] = langs.get(lang, 0) + 1
        keys = [f"b{i}" for i in range(DIMENSIONS)] + [f"l{k}" for k in langs] + ["n"]
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([*total.tolist(), *langs.values(), n], pa.int64())], names=["k", "n"])

    seen = train.select("lang", "text").mapInArrow(frequencies, "k string, n long").groupBy("k").agg(F.sum("n").alias("n"))
    fixed = seen.where(~F.col("k").startswith("l")).collect()
    langs = seen.where(F.col("k").startswith("l")).orderBy(F.desc("n"), "k").collect()
    df = np.zeros(DIMENSIONS)
    n = 0
    for r in fixed:
        if r["k"] == "n":
            n = r["n"]
        else:
            df[int(r["k"][1:])] = r["n"]
    each = max(1, sample // max(1, len(langs)))
    share = F.create_map(*[x for r in langs for x in (F.lit(r["k"][1:]), F.lit(each / r["n"]))]) if langs else None
    rows = []
    if langs:
        draw = F.pmod(F.xxhash64("doc_id", F.lit("centroids")), F.lit(1 << 30)) / float(1 << 30)
        drawn = counted(train.where(draw < F.try_element_at(share, "lang")).select("lang", "text", F.xxhash64("doc_id").alias("h")))
        rows = drawn.orderBy("h", "lang", "places", "times").limit(2 * max(sample, len(langs))).collect()
        missing = {r["k"][1:] for r in langs} - {r["lang"] for r in rows}
        if missing:  # too few for the draw
            order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
            first = train.where(F.col("lang").isin(sorted(missing))).withColumn("place", F.row_number().over(order)).where(F.col("place") <= each)
            rows += counted(first.select("lang", "text", F.xxhash64("doc_id").alias("h"))).orderBy("lang", "h", "places", "times").collect()
    return Centroids.fit([(r["lang"], dense(r["places"], r["times"])) for r in rows], np.log((1 + n) / (1 + df)) + 1)


def counted(rows: DataFrame) -> DataFrame:
    """lang, h, and the trigram counts of text as places and times: of bounded size, whatever the text's length."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [(at := np.flatnonzero(c), c[at]) for c in counts(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([at.astype("<u2").tobytes() for at, _ in each], pa.binary()), pa.array([n.astype("<f4").tobytes() for _, n in each], pa.binary())], names=["lang", "h", "places", "times"])

    return rows.mapInArrow(step, "lang string, h long, places binary, times binary")


def dense(places: bytes, times: bytes) -> np.ndarray:
    out = np.zeros(DIMENSIONS, np.float32)
    out[np.frombuffer(places, "<u2")] = np.frombuffer(times, "<f4")
    return out


def identify(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, top, rejected = shared.value.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(top, pa.float64()), pa.array(rejected, pa.bool_())], names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return docs.select("doc_id", held_out, "text").mapInArrow(step, "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
