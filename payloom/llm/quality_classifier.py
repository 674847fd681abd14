"""Quality classifier by co-training of two views.

The text view sees measures of the text itself; the metadata view sees what a page carries beside it: source, language tag and length. Both start from the same labelled
rows. In each round each view labels the unlabelled documents that it is surest of, if it was right about nearly all held-back rows that it was
as sure of, and the other view learns from them. At the end each view is calibrated
and a logistic model weighs the two into one score for every document, from 0 to 1, for quality 1.

Fitted on bounded samples, the lowest by hash: PER_CLASS labelled rows of each class whose crc32 remainder modulo 5 isn't 0, and POOL unlabelled documents. The
rates by source (hashed into SOURCES buckets) and language are counted over all labelled training rows. All documents are scored, whole.
Null and empty texts have zero measures; missing metadata has the rate of all. Repeated rows each get a score, and each counts as a row in fitting; further columns are ignored; an empty table
gives an empty result. Texts may be of any length. Without labels of both classes the score is the share of label 1, or 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import read_table, remainder
from payloom.llm.models import Boosted, Isotonic, Logistic, sample_labels

PER_CLASS, POOL = 2000, 3000
#: Rounds, the share of the pool that a view labels for the other in one at most, by class, and how often it must have been right.
ROUNDS, SUREST, SURE = 4, 0.03, 0.95
SOURCES = 1024

CLASSES = [re.compile(p).findall for p in (r"[A-Z]", r"[#*$%&|<>{}\\^~]", r"[.!?]", r"[,;:]", r"[0-9]", r"[^\x00-\x7f]", r"!!")]


def text_features(text: str | None) -> list[float]:
    text = text or ""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, chars, windows = max(1, len(words)), max(1, len(text)), max(1, len(words) - 2)
    return [
        np.log1p(len(words)),
        chars / n,
        len(set(words)) / n,
        len(set(zip(words, words[1:], words[2:]))) / windows,
        len(set(lines)) / max(1, len(lines)),
        len(words) / max(1, len(lines)),
        *[100 * len(find(text)) / chars for find in CLASSES],
    ]


def bucket(value: str | None) -> int:
    return crc32((value or "").encode()) % SOURCES


def rightness(held: np.ndarray, y: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Share of label 0 among held-back rows scored at most p, and of label 1 among those scored at least p, with one more row of each label."""
    order = np.argsort(held, kind="stable")
    ones = np.r_[0, np.cumsum(y[order])]
    upto, below = np.searchsorted(held[order], p, "right"), np.searchsorted(held[order], p, "left")
    return (upto - ones[upto] + 1) / (upto + 2), (ones[-1] - ones[below] + 1) / (len(y) - below + 2)


@dataclass
class CoTrained:
    rates: np.ndarray = field(default_factory=lambda: np.zeros((2, SOURCES)))  # by source and by language
    text: Boosted | None = None
    meta: Logistic | None = None
    calibrate: tuple = ()
    blend: Logistic | None = None
    prior: float = 0.0

    def meta_features(self, source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
        return [self.rates[0, bucket(source)], self.rates[1, bucket(lang)], np.log1p(max(0, n_chars or 0)), float(n_chars is None)]

    def views(self, xt: np.ndarray, xm: np.ndarray) -> np.ndarray:
        """Calibrated log-odds of both views."""
        p = np.stack([self.calibrate[0](self.text(xt)), self.calibrate[1](self.meta(xm))], 1).clip(0.002, 0.998)
        return np.log(p / (1 - p))

    def scores(self, rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """rows: text, source, lang, n_chars. Combined scores, and those of the views."""
        if self.text is None or not rows:
            return np.full(len(rows), self.prior), np.full((len(rows), 2), self.prior)
        z = self.views(np.array([text_features(r[0]) for r in rows]), np.array([self.meta_features(*r[1:]) for r in rows]))
        return self.blend(z), 1 / (1 + np.exp(-z))

    @classmethod
    def fit(cls, labelled: list[tuple], pool: list[tuple], counts: dict[int, int], rates: np.ndarray, rounds: int = ROUNDS) -> CoTrained:
        """labelled: doc_id, label, text features, source, lang, n_chars; pool: the same without a label."""
        total = sum(counts.values())
        model = cls(rates, prior=counts.get(1, 0) / total if total else 0.0)
        labelled, pool = sorted(labelled, key=lambda r: (r[0], r[2])), sorted(pool, key=lambda r: (r[0], r[1]))
        y = np.array([r[1] for r in labelled], int)
        last = np.array([crc32(f"part{r[0]}".encode()) % 4 == 0 for r in labelled], bool)
        if not len(y) or min(np.bincount(y[last], minlength=2).min(), np.bincount(y[~last], minlength=2).min()) < 5:
            return model
        weight = np.where(y == 1, counts[1] / (y == 1).sum(), counts[0] / (y == 0).sum())
        weight = weight / weight.mean()
        both = [(np.array([r[-4] for r in rows]), np.array([model.meta_features(*r[-3:]) for r in rows])) for rows in (labelled, pool or labelled[:1])]
        (xt, xm), (pt, pm) = both
        sets = [[v[~last], y[~last].astype(float), weight[~last]] for v in (xt, xm)]
        pools, free = (pt, pm), [np.ones(len(pt), bool), np.ones(len(pt), bool)]
        for turn in range(rounds + 1):
            model.text, model.meta = Boosted.fit(*sets[0], n_trees=40), Logistic.fit(*sets[1])
            if turn == rounds or not pool:
                break
            for view, other in ((0, 1), (1, 0)):
                learner = (model.text, model.meta)[view]
                p = learner(pools[view])
                bad, good = rightness(learner((xt, xm)[view][last]), y[last], p)
                order = np.argsort(p, kind="stable")
                n = max(1, int(SUREST * len(p)))
                sure = np.r_[order[:n][bad[order[:n]] >= SURE], order[-n:][good[order[-n:]] >= SURE]]
                sure = sure[free[other][sure]]
                free[other][sure] = False
                sets[other] = [np.concatenate(x) for x in zip(sets[other], (pools[other][sure], np.round(p[sure]), np.full(len(sure), 0.5)))]
        model.calibrate = tuple(Isotonic.fit(m(x[last]), y[last], weight[last]) for m, x in ((model.text, xt), (model.meta, xm)))
        model.blend = Logistic.fit(model.views(xt[last], xm[last]), y[last].astype(float), weight[last])
        return model


COLUMNS = ("text", "source", "lang", "n_chars")


def measured(rows: DataFrame) -> DataFrame:
    """Rows of doc_id, y and COLUMNS with the measures of the text in place of it."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [list(map(float, text_features(t))) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(x, pa.list_(pa.float64())), *batch.columns[3:]], names=batch.schema.names)

    return rows.mapInArrow(step, "doc_id long, y int, text array<double>, source string, lang string, n_chars long")


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, pool: int = POOL, rounds: int = ROUNDS) -> CoTrained:
    train = remainder(F.col("doc_id"), 5) != 0
    chosen, counts = sample_labels(labels, "quality", train, per_class)
    # features, not texts, come to the driver, so its memory is bounded whatever the texts' length
    labelled = measured(docs.select("doc_id", *COLUMNS).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", *COLUMNS)).collect()
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    rates = np.full((2, SOURCES), prior)
    marks = labels.where(F.col("quality").isin(0, 1) & train).groupBy("doc_id").agg(F.max("quality").alias("y"))
    seen = docs.select("doc_id", "source", "lang").join(marks, "doc_id")
    for k, column in enumerate(("source", "lang")):
        key = F.pmod(F.crc32(F.coalesce(column, F.lit(""))), F.lit(SOURCES)).alias("k")
        for r in seen.groupBy(key).agg(F.sum("y").alias("good"), F.count("*").alias("n")).collect():
            rates[k, r["k"]] = (r["good"] + 20 * prior) / (r["n"] + 20)
    spare = docs.where(train).select("doc_id", *COLUMNS)
    ids = spare.join(labels.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(pool)
    unlabelled = measured(spare.join(F.broadcast(ids), "doc_id").select("doc_id", F.lit(0).alias("y"), *COLUMNS)).collect()
    return CoTrained.fit([tuple(r) for r in labelled], [(r["doc_id"], *r[2:]) for r in unlabelled], counts, rates, rounds)


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, held_out, score, predicted, text_score, meta_score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, views = shared.value.scores(list(zip(*[c.to_pylist() for c in batch.columns[2:]])))
            columns = [batch.column(0), batch.column(1), pa.array(p, pa.float64()), pa.array((p >= 0.5).astype("i4")), pa.array(views[:, 0], pa.float64()), pa.array(views[:, 1], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "predicted", "text_score", "meta_score"])

    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return docs.select("doc_id", held_out, *COLUMNS).mapInArrow(step, "doc_id long, held_out boolean, score double, predicted int, text_score double, meta_score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
