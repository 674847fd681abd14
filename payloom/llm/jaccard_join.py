"""N-gram Jaccard join in the metric space of shingle sets, and the components of its links.

The Jaccard distance d obeys the triangle inequality, so with a pivot p two sets within tau of each other have |d(x, p) - d(y, p)| <= tau. Distances between
unrelated texts crowd at 1, where no pivot tells them apart and every window would hold every set; so the first regions form around local pivots:

1. Sets. Every text becomes its set of 64-bit shingle keys; equal sets form one class, known by a 128-bit seal.
2. Lone sets. Over the watched keys, those below a fixed threshold, a key found in one class only is private. A class with a larger private part of its
   set than a partner could miss has no link and goes no further.
3. First regions. The keys of the rest are ordered: watched ones by how many rows hold them, rarest first, then the others. Two linked classes share a key
   among the first n - ceil(t n) + 1 of each (prefix filter). The least class with a key in that part is the key's pivot, and a class is in the region of every pivot
   that it shares such a key with. Linked classes thus meet in a region.
4. Recursion. A region above REGION sets or MASS keys takes PIVOTS of its sets as pivots. Each set belongs to the Voronoi cell of the nearest one, and as a
   guest to each other cell whose pivot is at most 2 tau farther away, so linked sets meet in a cell where one of them is at home. Sets linked to pivots that are
   linked among themselves form a group, within which nothing is left to find. Cells of one group end here; others are joined or divided again.
   A region that division hardly helps is dealt out instead: what isn't in its largest group meets the whole of it, or, if that is too much for a task, each two blocks meet.
5. Join. In a region of a task's size each set is compared with those in its window of distances to the first set that no link connects to it yet.
6. Components come from alternating large-star and small-star steps on the links, all in tables.

Empty and null texts have an empty set, n_shingles 0 and themselves as component. Texts with fewer words than a shingle have one key of the whole sequence.
Repeated rows are members of one class; rows of one doc_id with different texts are connected by it. Rows without doc_id get their class's component. Extra columns are ignored,
and an empty table gives an empty result. Nothing is approximated but the equality of 64-bit keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import keys_of, materialize, mix64, read_table, release

#: Words of a shingle, and the similarity of linked sets: 100 * intersection >= PERCENT * union. Those of the query; both are parameters.
WIDTH, PERCENT = 3, 90
#: Sets and keys of a region that one task joins.
REGION, MASS = 250, 400_000
#: Pivots that a larger region is divided by, and the share of its pairs that its cells may have together; if they have more, it isn't divided.
PIVOTS, SHRUNK = 8, 0.5

_A, _B, _C = (np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))

Batches = Iterator[pa.RecordBatch]


def watched(percent: int) -> np.uint64:
    """Keys below this are watched: twice the share of its keys that a set can have without a partner, at most a third of all."""
    return np.uint64(int(min(2 * (100 - percent) / 100, 1 / 3) * 2**64))


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct keys of each whole text."""
    out = []
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            out.append(np.zeros(0, np.uint64))
            continue
        h = keys_of(words)
        n = min(width, len(words))
        key = np.full(len(words) - n + 1, n, np.uint64) * _B
        for k in range(n):
            key = mix64(key * _A + h[k : len(h) - n + 1 + k] * _C)
        out.append(np.unique(key))
    return out


def seal(keys: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(keys.tobytes())


def mark(keys: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(keys.tobytes())


def _marks(sets: list[np.ndarray]) -> np.ndarray:
    return np.array([mark(s) for s in sets], np.uint64).view(np.int64)


def _classify(width: int) -> Callable[[Batches], Batches]:
    def step(batches: Batches) -> Batches:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist(), width)
            columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([seal(s) if len(s) else None for s in sets], pa.binary()), pa.array(_marks(sets))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "seal", "mark"])

    return step


def _watched_keys(width: int, percent: int) -> Callable[[Batches], Batches]:
    """(key, mark) for the watched keys; mark is a 64-bit hash of the whole set."""

    def step(batches: Batches) -> Batches:
        top = watched(percent)
        for batch in batches:
            sets = [s for s in shingle_sets(batch.column(0).to_pylist(), width) if len(s)]
            low = [s[: np.searchsorted(s, top)].view(np.int64) for s in sets]
            keys = np.concatenate(low) if low else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(_marks(sets), [len(w) for w in low]))], names=["key", "mark"])

    return step


def _whole_sets(width: int) -> Callable[[Batches], Batches]:
    """(seal, n, keys) of the texts whose set has the seal that was asked for."""

    def step(batches: Batches) -> Batches:
        for batch in batches:
            sets = shingle_sets(batch.column(0).to_pylist(), width)
            kept = [(w, s) for w, s in zip(batch.column(1).to_pylist(), sets) if seal(s) == w]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.binary()), pa.array([len(s) for _, s in kept], pa.int64()), pa.array([s.tobytes() for _, s in kept], pa.binary())], names=["seal", "n", "keys"])

    return step


def _first_keys(percent: int) -> Callable[[Batches], Batches]:
    """(seal, key, spare, last): the watched keys of each set, and if the prefix is longer than these by spare, as many of the next ones, with last."""

    def step(batches: Batches) -> Batches:
        top = watched(percent)
        for batch in batches:
            keys, spares, lasts, sizes = [], [], [], []
            for blob in batch.column(1).to_pylist():
                s = np.frombuffer(blob, np.uint64)
                low = int(np.searchsorted(s, top))
                spare = len(s) * (100 - percent) // 100 + 1 - low
                own = s[: low + max(0, spare)]
                keys.append(own.view(np.int64))
                spares.append(np.full(len(own), spare))
                lasts.append(np.arange(len(own)) >= low)
                sizes.append(len(own))
            owner = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
            flat = [np.concatenate(x) if x else np.zeros(0, t) for x, t in ((keys, np.int64), (spares, np.int64), (lasts, bool))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), *map(pa.array, flat)], names=["seal", "key", "spare", "last"])

    return step


def linked(inter: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    return 100 * inter >= percent * (x + y - inter)


def join_region(sets: list[np.ndarray], percent: int = PERCENT, home: np.ndarray | None = None, group: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect all linked sets, as pairs of places. Each set meets those behind it that no link connects to it yet, in the window of distances to the first set.

    Two sets are compared if one is at home. Sets of one group (not -1) are known to be connected."""
    m, tau = len(sets), (100 - percent) / 100
    home = np.ones(m, bool) if home is None else home
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets])
    marked = np.zeros(ids.max() + 1, bool)
    starts = np.r_[0, np.cumsum(sizes)]
    own = [ids[a:b] for a, b in zip(starts, starts[1:])]

    def common(pivot: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        marked[pivot] = True
        found = np.add.reduceat(marked[flat], starts, dtype=np.int64)
        marked[pivot] = False
        return found

    first = common(own[0], ids, starts[:-1])
    distance = 1 - first / (sizes[0] + sizes - first)
    order = np.argsort(distance, kind="stable")
    to_first = distance[order]
    cluster, links = np.arange(m), []
    if group is not None:
        for g in np.unique(group[group >= 0]):
            cluster[group == g] = np.flatnonzero(group == g)[0]
    left = len(np.unique(cluster))
    for p in range(m):
        if left == 1:
            break
        low, high = np.searchsorted(to_first, distance[p] - tau - 1e-9), np.searchsorted(to_first, distance[p] + tau + 1e-9, "right")
        near = order[low:high]
        near = near[(near > p) & (cluster[near] != cluster[p]) & (home[near] | home[p])]
        near = near[100 * np.minimum(sizes[near], sizes[p]) >= percent * np.maximum(sizes[near], sizes[p])]
        if not len(near):
            continue
        inter = common(own[p], np.concatenate([own[x] for x in near]), np.r_[0, np.cumsum(sizes[near])[:-1]])
        for x in near[linked(inter, sizes[p], sizes[near], percent)]:
            links.append((int(x), p))
            if cluster[x] != cluster[p]:
                cluster[cluster == cluster[x]] = cluster[p]
                left -= 1
    return links


def divide(pivots: list[np.ndarray], sets: list[np.ndarray], percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each set and pivot: distance, link, and whether the set is at home in the pivot's cell or its guest; and each set's group, or -1."""
    tau = (100 - percent) / 100
    sizes, flat = np.array([len(s) for s in sets]), np.concatenate(sets)
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    shared = lambda p, flat, starts: np.add.reduceat(p[np.minimum(np.searchsorted(p, flat), len(p) - 1)] == flat, starts, dtype=np.int64)
    inter = np.stack([shared(p, flat, starts) for p in pivots], 1)
    lengths = np.array([len(p) for p in pivots])
    distance = 1 - inter / (sizes[:, None] + lengths - inter)
    link = linked(inter, sizes[:, None], lengths, percent)
    member = distance <= distance.min(1, keepdims=True) + 2 * tau + 1e-9
    # pivots that are linked among themselves, alike in every part of a region
    root = np.arange(len(pivots))
    for i, p in enumerate(pivots):
        for j in np.flatnonzero(linked(np.array([shared(p, q, np.zeros(1, int))[0] for q in pivots]), len(p), lengths, percent)):
            root[root == root[j]] = root[i]
    group = np.where(link.any(1), root[link.argmax(1)], -1)
    return distance, link, member, group


LINKS = "seal binary, other binary"
CELLS = "parent string, cell string, seal binary, home boolean, own boolean, grp int, d double, other binary"


def _join_part(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def step(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("seal").drop_duplicates("seal")
        names = group["seal"].to_numpy()
        links = join_region([np.frombuffer(x, np.uint64) for x in group["keys"]], percent, group["home"].to_numpy(bool), group["grp"].to_numpy(int))
        return pd.DataFrame([(names[x], names[p]) for x, p in links], columns=["seal", "other"])

    return step


def _divide_part(percent: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Links to the pivots, and a row for each set and cell that it is in."""

    def step(group: pd.DataFrame) -> pd.DataFrame:
        cell = group["cell"].iat[0]
        pivots, sets = group[group["pivot"] >= 0].sort_values("pivot"), group[group["pivot"] < 0].sort_values("seal").drop_duplicates("seal")
        rows = []
        if len(sets):
            names, others, at_home = sets["seal"].to_numpy(), pivots["seal"].to_numpy(), sets["home"].to_numpy(bool)
            distance, link, member, group_of = divide([np.frombuffer(x, np.uint64) for x in pivots["keys"]], [np.frombuffer(x, np.uint64) for x in sets["keys"]], percent)
            nearest = distance.argmin(1)
            rows += [(cell, None, names[i], False, False, 0, 0.0, others[j]) for i, j in zip(*np.nonzero(link)) if names[i] != others[j]]
            rows += [(cell, f"{cell}.{j}", names[i], bool(at_home[i]), bool(nearest[i] == j), int(group_of[i]), float(distance[i, j]), None) for i, j in zip(*np.nonzero(member))]
        return pd.DataFrame(rows, columns=["parent", "cell", "seal", "home", "own", "grp", "d", "other"])

    return step


def region_links(members: DataFrame, sets: DataFrame, percent: int = PERCENT, size: int = REGION, mass: int = MASS) -> DataFrame:
    """Links (seal, other) that connect all linked sets of each region. members: (region, seal); sets: (seal, n, keys)."""
    tau = (100 - percent) / 100
    found: list[DataFrame] = []

    def with_keys(rows: DataFrame) -> DataFrame:
        return rows.join(sets.select("seal", "keys"), "seal")

    def load(rows: DataFrame, *more) -> DataFrame:
        """Times that each cell fills a task."""
        return rows.join(sets.select("seal", "n"), "seal").groupBy("cell").agg(F.greatest(F.count("*") / size, F.sum("n") / mass).alias("load"), F.count("*").alias("c"), *more)

    def join_parts(rows: DataFrame) -> None:
        found.append(with_keys(rows.select("cell", "part", "seal", "home", "grp")).groupBy("cell", "part").applyInPandas(_join_part(percent), LINKS))

    rows = members.select(F.hex("region").alias("cell"), "seal", F.lit(True).alias("home"), F.lit(-1).alias("grp"), F.lit(False).alias("stuck"))
    turn, most = 0, members.count()
    while True:
        pivots = F.array_distinct(F.array(*[F.min_by("seal", F.xxhash64("seal", F.lit(PIVOTS * turn + j))) for j in range(PIVOTS)]))
        # nothing is left to find where all are guests or all are in one group
        totals = load(rows, F.max("home").alias("any_home"), F.min("grp").alias("low"), F.max("grp").alias("high"), F.max("stuck").alias("stuck"), pivots.alias("pivots"))
        kind = F.when(F.col("load") <= 1, "join").when(F.col("stuck"), "deal").otherwise("divide")
        totals = materialize(totals.where("c > 1 AND any_home AND (low <> high OR low < 0)").select("cell", "load", "c", "pivots", kind.alias("kind")), "jaccard-cells", most)
        kinds = {r["kind"] for r in totals.select("kind").distinct().collect()}
        marked = rows.drop("stuck").join(totals.select("cell", "load", "kind"), "cell")
        if "join" in kinds:
            join_parts(marked.where("kind = 'join'").withColumn("part", F.lit("")))
        if "deal" in kinds:
            join_parts(_deal(marked.where("kind = 'deal'"), load, most))
        if "divide" not in kinds:
            break
        wide = marked.where("kind = 'divide'").withColumn("parts", F.ceil("load").cast("int"))
        own = wide.select("cell", "seal", "home", "grp", F.lit(-1).alias("pivot"), F.pmod(F.xxhash64("seal", F.lit(turn)), F.col("parts")).cast("int").alias("part"))
        heads = totals.where("kind = 'divide'").select("cell", F.posexplode("pivots").alias("pivot", "seal"), F.explode(F.sequence(F.lit(0), F.ceil("load").cast("int") - 1)).alias("part"))
        dealt = own.unionByName(heads.select("cell", "seal", F.lit(False).alias("home"), F.lit(-1).alias("grp"), "pivot", "part"))
        cut = materialize(with_keys(dealt).groupBy("cell", "part").applyInPandas(_divide_part(percent), CELLS), "jaccard-divided")
        found.append(cut.where("other IS NOT NULL").select("seal", "other"))
        inside = cut.where("other IS NULL").drop("other")
        cells = inside.groupBy("parent", "cell").agg(F.count("*").alias("n")).groupBy("parent").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"))
        # what is said of cells is written, for then it's shuffled for the joins with their sets, or sent if it's small, and a cell of very many sets can be split
        divided = cells.join(totals.select(F.col("cell").alias("parent"), "c"), "parent").select("parent", (F.col("pairs") > SHRUNK * F.col("c") * F.col("c")).alias("stuck"))
        divided = materialize(divided, "jaccard-judged", most)
        judged = inside.join(divided, "parent").where("NOT stuck OR own")
        children = judged.select(F.when(F.col("stuck"), F.col("parent")).otherwise(F.col("cell")).alias("cell"), "seal", (F.col("home") & (F.col("stuck") | F.col("own"))).alias("home"), "grp", F.when(~F.col("stuck"), F.col("d")).alias("d"), "stuck")
        # of a cell's largest group only the sets in the window of the others' distances matter, and the others themselves
        named = _main(children, most)
        edges = materialize(named.where("NOT in_main").groupBy("cell").agg(F.min("d").alias("low"), F.max("d").alias("high")), "jaccard-edges", most)
        window = named.join(edges, "cell").where(~F.col("in_main") | F.col("stuck") | F.col("d").between(F.col("low") - tau - 1e-9, F.col("high") + tau + 1e-9))
        rows, turn = materialize(window.select("cell", "seal", "home", "grp", "stuck"), "jaccard-window", cut.count()), turn + 1
        most = rows.count()
    out = found[0] if found else sets.select("seal", F.col("seal").alias("other")).limit(0)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _main(rows: DataFrame, most: int) -> DataFrame:
    """in_main: whether a set is in the largest group of its cell. most: sets of all cells."""
    groups = rows.where("grp >= 0").groupBy("cell", "grp").agg(F.count("*").alias("of_group")).groupBy("cell").agg(F.max_by("grp", F.struct("of_group", "grp")).alias("main"))
    groups = materialize(groups, "jaccard-main", most)
    return rows.join(groups, "cell", "left").withColumn("in_main", F.coalesce(F.col("grp") == F.col("main"), F.lit(False))).drop("main")


def _deal(rows: DataFrame, load: Callable[..., DataFrame], most: int) -> DataFrame:
    """Parts of cells that pivots don't divide. What isn't in a cell's largest group goes to each part, and the group is dealt out; if the former
    is more than half a task, the cell is cut into blocks, of which each two meet."""
    named = _main(rows, most)
    others = materialize(load(named.where("NOT in_main").select("cell", "seal")).select("cell", F.col("load").alias("others")), "jaccard-others", most)
    named = named.join(others, "cell")  # a cell of one group isn't dealt
    parts = F.ceil(2 * F.col("load")).cast("int")
    few = named.where("others <= 0.5")
    few = few.withColumn("part", F.explode(F.when(F.col("in_main"), F.array(F.pmod(F.xxhash64("seal", F.lit("deal")), parts).cast("int"))).otherwise(F.sequence(F.lit(0), parts - 1)))).withColumn("part", F.col("part").cast("string"))
    many = named.where("others > 0.5").withColumns({"blocks": parts, "block": F.pmod(F.xxhash64("seal", F.lit("block")), parts).cast("int")})
    many = many.withColumn("beside", F.explode(F.array_remove(F.sequence(F.lit(0), F.col("blocks") - 1), F.col("block")))).withColumn("part", F.concat_ws(":", F.least("block", "beside"), F.greatest("block", "beside")))
    columns = ["cell", "part", "seal", "home", "grp"]
    return few.select(*columns).unionByName(many.select(*columns))


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, but for roots themselves. links: (seal, other)."""
    spark = links.sparkSession
    edges = materialize(links.select(F.greatest("seal", "other").alias("u"), F.least("seal", "other").alias("v")).where("u != v").distinct(), "components")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        # the least neighbours are written, so that both sides of the joins are shuffled for them, and a node with very many neighbours can be split
        both = edges.union(edges.select("v", "u"))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components-least", 2 * now[0])
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        lower = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "components-least", now[0])
        small = large.join(lower, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        # a step never adds links
        before, old, edges = now, edges, materialize(small, "components", now[0])
        release(spark, old, least, lower)


def regions(sets: DataFrame, shared: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(region, seal): each set in the region of every pivot that it shares a key of its prefix with, the pivot itself included. shared: (key, df) of watched keys in several classes."""
    keys = sets.select("seal", "keys").mapInArrow(_first_keys(percent), "seal binary, key long, spare long, last boolean")
    # private keys come first in the order and need no region: of the watched keys those that aren't in shared
    known = keys.join(shared, "key", "left").where("last OR df IS NOT NULL")
    ranked = known.groupBy("seal", "spare").agg(F.array_sort(F.collect_list(F.struct("last", "df", "key"))).alias("ks"), F.count_if(~F.col("last")).alias("n_shared"))
    length = (F.col("spare") + F.col("n_shared")).cast("int")
    prefix = materialize(ranked.where(length > 0).select("seal", F.explode(F.slice("ks", F.lit(1), length)).alias("k")).select("seal", "k.key"), "jaccard-prefix")
    # written, so that both sides of the join are shuffled for it, and a key that a large part of all sets has can be split
    pivots = materialize(prefix.groupBy("key").agg(F.min("seal").alias("region"), F.count("*").alias("c")).where("c > 1").select("key", "region"), "jaccard-pivots", prefix.count())
    return materialize(prefix.join(pivots, "key").select("region", "seal").distinct(), "jaccard-regions")


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, seal) of every row, and (seal, component) of every class of equal sets."""
    rows = materialize(docs.select("doc_id", "text").mapInArrow(_classify(width), "doc_id long, n long, seal binary, mark long"), "jaccard-sets")
    groups = rows.where("n > 0").groupBy("seal").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("mark").alias("mark"))
    # the texts are read again here, for stored or shuffled with their rows the keys would be most of the disk that is used
    keys = docs.select("text").mapInArrow(_watched_keys(width, percent), "key long, mark long")
    each = keys.groupBy("key").agg(F.min("mark").alias("low"), F.max("mark").alias("high"), F.count("*").alias("df"))
    alone = F.col("low") == F.col("high")
    seen = each.groupBy(F.when(alone, F.col("low")).alias("mark"), F.when(~alone, F.col("key")).alias("key")).agg(F.count("*").alias("private"), F.max("df").alias("df"))
    seen = materialize(seen, "jaccard-keys")
    lone = F.coalesce(100 * F.col("private") > (100 - percent) * F.col("n"), F.lit(False)) | F.col("rep").isNull()
    groups = materialize(groups.join(seen.where("mark IS NOT NULL").select("mark", "private"), "mark", "left").select("seal", "rep", lone.alias("lone")), "jaccard-classes", rows.count())
    # how many stay open has no bound, so they aren't broadcast at any size
    open_ = groups.where("NOT lone").select(F.col("rep").alias("doc_id"), "seal")
    sets = materialize(docs.select("doc_id", "text").join(open_.hint("merge"), "doc_id").select("text", "seal").mapInArrow(_whole_sets(width), "seal binary, n long, keys binary"), "jaccard-whole")
    again = sets.groupBy("seal").count().where("count > 1").select("seal")
    if not again.isEmpty():  # repeated rows of one doc_id
        sets = materialize(sets.join(again, "seal", "left_anti").unionByName(sets.join(again, "seal", "left_semi").dropDuplicates(["seal"])), "jaccard-whole")
    links = region_links(regions(sets, seen.where("key IS NOT NULL").select("key", "df"), percent), sets, percent)
    several = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("seal").alias("other"), F.max("seal").alias("last")).where("other < last").select("doc_id", "other")
    if not several.isEmpty():  # one doc_id with several texts
        links = links.unionByName(rows.where("n > 0").join(several, "doc_id").where("seal > other").select("seal", "other"))
    roots = components(links)
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    least = groups.join(roots, F.col("seal") == F.col("node")).groupBy("root").agg(F.min("rep").alias("component"))
    found = groups.join(roots.join(least, "root").select(F.col("node").alias("seal"), "component"), "seal", "left").select("seal", F.coalesce("component", "rep").alias("component"))
    # written, so that both sides of the join with the rows are shuffled for it, and a large class of copies can be split
    return rows.select("doc_id", "n", "seal"), materialize(found, "jaccard-components", rows.count())


def join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, one row per row of docs."""
    rows, groups = classes(docs, width, percent)
    return rows.join(groups, "seal", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The document with the smallest doc_id of each component, all columns; of rows with that doc_id the one with the least text. Rows without doc_id stay."""
    joined = materialize(join(docs.where(F.col("doc_id").isNotNull()), width, percent), "jaccard-components")
    stay = joined.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("rows_of_it"))
    kept = docs.join(stay.select("doc_id").hint("merge"), "doc_id", "left_semi")
    again = materialize(stay.where("rows_of_it > 1").select("doc_id"), "jaccard-repeated", joined.count())
    if not again.isEmpty():
        every = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        first = kept.join(again, "doc_id", "left_semi").select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), every.alias("_row")).groupBy("_id").agg(F.min_by("_row", F.struct("_text", F.xxhash64("_row"))).alias("_row"))
        kept = kept.join(again, "doc_id", "left_anti").unionByName(first.select("_row.*"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where(F.col("doc_id").isNull()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read_table(spark, sf_dir, "documents"))


def sql() -> str:
    """The query in DuckDB's SQL: links through an equi join on shingles, components by recursive reachability."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents d LEFT JOIN c USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) m USING (doc_id)"""
