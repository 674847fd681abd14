"""Centroid clustering: plain Lloyd rounds over integer vectors.

Every component x becomes the integer floor(256 * x). Centroids start as the vectors whose identifiers hash least, so the start doesn't depend on the
order or the partitions of the table. In a round the centroids are broadcast, mapInPandas finds each vector's nearest centroid in NumPy
(exact integer distances; ties go to the smallest number) and sums the vectors of each centroid over its partition; only these sums,
at most centroids x components rows a partition, are shuffled and merged. The driver holds the centroids and nothing else.

A vector counts if it has exactly DIMENSIONS components, none null, NaN or infinite; others give no row, nor does a null vector. Repeated rows each get a row, and each
weighs in its centroid. A null identifier is no start (its hash is null); if several rows of a start's identifier differ, the least vector comes first.
With fewer vectors than CLUSTERS there are as many centroids as vectors, and an empty table gives no rows. Integers are held within +-LARGEST, so that a distance
always fits into a long: components beyond +-2^19 count as +-2^19. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import materialize, read_table

CLUSTERS, ROUNDS, DIMENSIONS, SCALE, SEED = 40, 5, 64, 256, 2
#: Largest magnitude of an integer component: 64 squares of twice as much fit into a long.
LARGEST = (1 << 27) - 1


def finite(vector: Column, dimensions: int) -> Column:
    """Whether a vector has so many components, all of them finite numbers."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return F.coalesce((F.size(vector) == dimensions) & ~F.exists(vector, odd), F.lit(False))


def integers(df: DataFrame, key: str, vector: str, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(key, v): the vectors that count, as arrays of long."""
    whole = lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("long")
    kept = df.select(F.col(key).alias("key"), F.col(vector).alias("v")).where(finite(F.col("v"), dimensions))
    return kept.select("key", F.transform("v", whole).alias("v"))


def starts(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the least hash of seed and key, in its order."""
    hashed = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256).alias("hash"), "v").where("hash IS NOT NULL")
    return np.array([r["v"] for r in hashed.orderBy("hash", "v").limit(clusters).collect()], np.int64)  # at most `clusters` rows


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of the nearest centroid of each row; argmin takes the lowest number of a tie."""
    far = np.empty((len(x), len(centroids)), np.int64)
    for j, c in enumerate(centroids):
        gap = x - c
        far[:, j] = np.einsum("ij,ij->i", gap, gap)
    best = far.argmin(1)
    return best, far[np.arange(len(x)), best]


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the exact floor of the mean of a centroid's vectors; one without vectors stays."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count = np.zeros_like(shared.value), np.zeros(len(shared.value), np.int64)
        for batch in batches:
            if len(batch):
                x = np.stack(batch["v"].to_numpy())
                best, _ = nearest(x, shared.value)
                np.add.at(total, best, x)
                count += np.bincount(best, minlength=len(count))
        hit = np.flatnonzero(count)
        width = total.shape[1]
        yield pd.DataFrame({"cluster": np.repeat(hit, width), "place": np.tile(np.arange(width), len(hit)), "part": total[hit].ravel(), "n": np.repeat(count[hit], width)})

    parts = vectors.select("v").mapInPandas(sums, "cluster int, place int, part long, n long")
    # decimals, because the sum over all partitions may leave a long
    merged = parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(20,0)")).alias("part"), F.sum("n").alias("n")).collect()  # centroids x components rows
    shared.unpersist()
    out = centroids.copy()
    for r in merged:
        out[r["cluster"], r["place"]] = int(r["part"]) // r["n"]
    return out


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(key, cluster, distance) of every vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                best, distance = nearest(np.stack(batch["v"].to_numpy()), shared.value)
                yield pd.DataFrame({"key": batch["key"], "cluster": best, "distance": distance})

    return vectors.mapInPandas(each, f"key {vectors.schema['key'].dataType.simpleString()}, cluster int, distance long")


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """((key, cluster, distance) of every vector that counts, the last centroids). The table is read anew in each round; nothing of its size is kept."""
    vectors = integers(df, key, vector, dimensions, scale)
    centroids = starts(vectors, clusters, seed)
    if not len(centroids):
        # no vector has a key to start from: all of them, if there are any, are one group around the origin
        centroids = np.zeros((1, dimensions), np.int64)
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    return assign(vectors, centroids).withColumnRenamed("key", key), centroids


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, centroids = cluster(read_table(spark, sf_dir, "embeddings"))
    found = materialize(found, "lloyd-assigned")
    spread = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    by = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(spread("distance").alias("d")).collect()}  # a row for each centroid
    digest = lambda c: sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    table = spark.createDataFrame([(j, by.get(j, 0), sum(by.values()), digest(c)) for j, c in enumerate(centroids)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row for each centroid


def sql() -> str:
    """The query in DuckDB's SQL, for vectors within +-2^19: a common table for each round."""
    near = f"""SELECT r, vec_id, cluster, distance FROM (SELECT r, vec_id, cluster, distance, row_number() OVER (PARTITION BY r ORDER BY distance, cluster) AS k
  FROM (SELECT r, vec_id, cluster, CAST(list_sum(list_transform(range(1, {DIMENSIONS + 1}), lambda i: (e.v[i] - c.v[i]) * (e.v[i] - c.v[i]))) AS BIGINT) AS distance FROM e, c{{n}} c)) WHERE k = 1"""
    out = f"""WITH e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
c0 AS MATERIALIZED (SELECT CAST(k - 1 AS INT) AS cluster, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('{SEED}:' || CAST(vec_id AS VARCHAR)), v) AS k FROM e WHERE vec_id IS NOT NULL) WHERE k <= {CLUSTERS}),"""
    for n in range(ROUNDS):
        out += f"""
a{n} AS MATERIALIZED ({near.format(n=n)}),
m{n} AS MATERIALIZED (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM (SELECT cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range(1, {DIMENSIONS + 1})) AS i FROM a{n} JOIN e USING (r)) GROUP BY 1, 2) GROUP BY 1),
c{n + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (cluster)),"""
    return out + f"""
z AS MATERIALIZED ({near.format(n=ROUNDS)})
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM z JOIN c{ROUNDS} c USING (cluster)"""
