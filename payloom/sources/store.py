"""Versioned Parquet tables. A version names the parts of each table; runs stage further parts and publish all they staged by one small write."""

from __future__ import annotations

import json
import os
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.schemas import KEYS, TABLES
from payloom.sources.shared import measured

#: A part's key filter has blocks of BLOCK_BITS bits for BLOCK_KEYS keys each, and PROBES bits a key, all in one block: about one key in 100,000 is taken for another.
BLOCK_BITS, BLOCK_KEYS, PROBES = 32_768, 1024, 8
#: Parts of fewer rows have no key filter; reading their keys costs no more than a filter.
FILTERED = 100_000
#: A table of more parts, or more deletions, is put together anew by a run.
MOST_PARTS, MOST_DELETIONS = 256, 16


class Conflict(RuntimeError):
    """Another run published first."""


class Store:
    """Readers see the last published version. What a run staged is seen by the run itself only, and by nobody if it fails before it publishes.

    Of each part the version lists the number of rows, the largest id and the least and largest value of each key column; large parts have a key filter beside them. So a run that looks
    keys up reads only the parts that may hold them. Rows go by small tables of deleted ids, which hold for the parts staged before them and are applied in reading until a
    table is put together anew."""

    def __init__(self, spark: SparkSession, root: str, filtered: int = FILTERED):
        self.spark, self.root, self.filtered = spark, root.rstrip("/"), filtered
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._moves: list[tuple[str, str]] = []
        self.roll_back()

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _read(self) -> tuple[int, dict[str, dict]]:
        """Number and tables of the newest published version."""
        names = [n for n in self._names("_published") if n.isdigit()]
        if not names:
            return 0, {}
        rows = self.spark.read.text(f"{self.root}/_published/{names[-1]}", wholetext=True)
        return int(names[-1]), json.loads(rows.first()[0])

    def files(self, path: str) -> list[str]:
        """The file, those that a pattern fits, or the CSV files of a folder, by name; none if there is nothing."""
        there = self._path(path)
        fs = there.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = []
        for status in fs.globStatus(there) or []:
            inside = [s.getPath() for s in fs.listStatus(status.getPath())] if status.isDirectory() else [status.getPath()]
            found += [p.toString() for p in inside if not status.isDirectory() or p.getName().endswith(".csv")]
        return sorted(found)

    # --- reading

    def parts(self, name: str) -> list[dict]:
        return self.tables[name]["parts"]

    def rows(self, name: str) -> int:
        """How many rows a table has, by the version list alone."""
        return sum(p["rows"] for p in self.parts(name)) - sum(d["rows"] for d in self.tables[name]["deleted"])

    def top(self, name: str) -> int:
        """The largest id a table ever had, by the version list alone."""
        return max((p["top"] for p in self.parts(name)), default=0)

    def _load(self, folders: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], schema)

    def table(self, name: str, parts: list[dict] | None = None) -> DataFrame:
        """All rows of a table, those staged by this run included; of some of its parts, if these are given. Parts no deletion came after are read as they are."""
        parts, deleted, key = self.parts(name) if parts is None else parts, self.tables[name]["deleted"], KEYS[name][0]
        newest = self._load([f"{name}/{p['name']}" for p in parts if p["after"] == len(deleted)], TABLES[name])
        older = [(n, [f"{name}/{p['name']}" for p in parts if p["after"] == n]) for n in sorted({p["after"] for p in parts}) if n < len(deleted)]
        if not older:
            return newest
        rows = reduce(DataFrame.unionByName, [self._load(f, TABLES[name]).withColumn("_after", F.lit(n)) for n, f in older])
        gone = reduce(DataFrame.unionByName, [self._load([f"{name}/{d['name']}"], f"{key} long").withColumn("_deletion", F.lit(n)) for n, d in enumerate(deleted, 1)])
        last = gone.groupBy(F.col(key).alias("_id")).agg(F.max("_deletion").alias("_deletion"))
        alive = rows.join(last, (rows[key] == last["_id"]) & (rows["_after"] < last["_deletion"]), "left_anti").drop("_after")
        return alive.unionByName(newest)

    def holding(self, name: str, keys: DataFrame) -> list[dict]:
        """The parts that may hold a row with one of the keys: by range of each key column first, then by the filters of parts with more rows than there are keys.
        keys has a table's key columns; it is gone over twice."""
        columns = KEYS[name][1]
        if not self.parts(name):
            return []
        ends = [x for c in columns for x in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"), F.count(c).alias(f"n_{c}"))]
        seen = keys.agg(F.count("*").alias("n"), *ends).first()  # one row

        def meets(part: dict, c: str) -> bool:
            """Ranges don't tell of nulls, so keys with one may be anywhere."""
            ours, theirs = (seen[f"low_{c}"], seen[f"high_{c}"]), part["range"][c]
            return seen[f"n_{c}"] < seen["n"] or None in theirs or ours[0] <= theirs[1] and theirs[0] <= ours[1]

        near = [p for p in self.parts(name) if seen["n"] and p["rows"] and all(meets(p, c) for c in columns)]
        tested = [p for p in near if p["blocks"] and p["rows"] > seen["n"]]
        if not tested:
            return near
        own = F.explode(F.array(*[F.struct(F.lit(p["name"]).alias("part"), F.lit(p["blocks"]).alias("blocks")) for p in tested]))
        asked = keys.select(F.xxhash64(*columns).alias("h")).distinct().select("h", own.alias("p")).select("h", "p.part", F.pmod("h", "p.blocks").alias("block"))
        filters = self._load([f"_keys/{p['name']}" for p in tested], "part string, block long, bits binary")

        def bit(place):
            byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            return F.getbit(byte, (place % 8).cast("int")) == 1

        every = reduce(lambda a, b: a & b, [bit(F.pmod(F.xxhash64("h", F.lit(i)), F.lit(BLOCK_BITS))) for i in range(PROBES)])
        hit = {r["part"] for r in asked.join(filters, ["part", "block"]).where(every).select("part").distinct().collect()}  # a row for each part
        return [p for p in near if p not in tested or p["name"] in hit]

    def lookup(self, name: str, keys: DataFrame) -> DataFrame:
        """The rows of all parts that may hold one of the keys."""
        return self.table(name, self.holding(name, keys))

    # --- staging

    def _new(self) -> str:
        self._last += 1
        return f"{self.step + 1:08d}-{self._last:04d}-{uuid4().hex[:8]}"

    def migrate(self) -> bool:
        """Create missing tables, empty; whether there were any."""
        missing = [t for t in TABLES if t not in self.tables]
        self.tables = self.tables | {t: {"parts": [], "deleted": []} for t in missing}
        if missing:
            self.publish()
        return bool(missing)

    def stage(self, name: str, rows: DataFrame, replace: bool = False, counts: dict | None = None, **measures: Column) -> DataFrame:
        """Write rows as a further part of a table, or as the whole of its next version; they are read back from there. What the version lists of a part is measured as it is written,
        and so are further measures, which `counts` takes."""
        part, (key, columns) = self._new(), KEYS[name]
        path, old = f"{self.root}/{name}/{part}", self.tables[name]
        ends = {f"{f.__name__}_{c}": f(c) for c in columns for f in (F.min, F.max)}
        found = measured(rows, path, [c.split()[0] for c in TABLES[name].split(", ")], rows=F.count("*"), top=F.max(key), **ends, **measures)
        if counts is not None:
            counts.update({m: found[m] for m in measures})
        entry = {"name": part, "rows": found["rows"], "top": found["top"] or 0, "range": {c: [found[f"min_{c}"], found[f"max_{c}"]] for c in columns}, "after": 0 if replace else len(old["deleted"]), "blocks": 0}
        entry["top"] = max(entry["top"], self.top(name)) if replace else entry["top"]  # ids of deleted rows aren't given again
        staged = self._load([f"{name}/{part}"], TABLES[name])
        if found["rows"] >= self.filtered:
            entry["blocks"] = 1 + found["rows"] // BLOCK_KEYS
            hashed = staged.select(F.xxhash64(*columns).alias("h")).select(F.pmod("h", F.lit(entry["blocks"])).alias("block"), F.explode(F.array(*[F.pmod(F.xxhash64("h", F.lit(i)), F.lit(BLOCK_BITS)) for i in range(PROBES)])).alias("place"))
            bits = hashed.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")).select(F.lit(part).alias("part"), "block", "bits")
            bits.write.mode("overwrite").parquet(f"{self.root}/_keys/{part}")
        kept = {"parts": [], "deleted": []} if replace else old
        self.tables = self.tables | {name: {"parts": [*kept["parts"], entry] if found["rows"] or replace else kept["parts"], "deleted": kept["deleted"]}}
        return staged

    def delete(self, name: str, ids: DataFrame) -> int:
        """Stage the deletion of rows by id, from all parts staged so far; how many ids. Ids are of rows that are there, each once."""
        part, key = self._new(), KEYS[name][0]
        n = measured(ids.select(F.col(key).cast("long").alias(key)), f"{self.root}/{name}/{part}", None, rows=F.count("*"))["rows"]
        if n:
            old = self.tables[name]
            self.tables = self.tables | {name: {"parts": old["parts"], "deleted": [*old["deleted"], {"name": part, "rows": n}]}}
        return n

    def move_when_published(self, staged: str, final: str) -> None:
        """A folder outside the tables that takes its place once this run is published, and goes if it fails."""
        self._moves.append((staged, final))

    # --- publishing

    def publish(self) -> None:
        """Switch to all that was staged, at once. If another run published meanwhile, this fails with Conflict and nothing changes."""
        step = self.step + 1
        if not self._put_if_absent(f"{self.root}/_published/{step:08d}", json.dumps(self.tables, default=str).encode()):
            raise Conflict(f"version {step} was published by another run")
        for staged, final in self._moves:
            fs = self._path(final).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            fs.delete(self._path(final), True)
            fs.rename(self._path(staged), self._path(final))
        self.step, self._last, self._moves = step, -1, []

    def _put_if_absent(self, path: str, content: bytes) -> bool:
        """Write a small file whole, if nobody else did. A local file system links a finished file to its name; HDFS renames one, which fails where the name is taken; stores of objects
        make an object visible when it is closed, and refuse to create one that is there."""
        final, scheme = self._path(path), self._fs.getUri().getScheme()
        self._fs.mkdirs(final.getParent())
        renamed = scheme in ("file", "hdfs", "viewfs")
        target = self._path(f"{self.root}/_staged-{uuid4().hex}") if renamed else final
        try:
            out = self._fs.create(target, False)
            out.write(bytearray(content))
            out.close()
        except Exception as e:
            if "AlreadyExists" in str(e) or self._fs.exists(final):
                return False
            raise
        if scheme == "file":
            try:
                os.link(target.toUri().getPath(), final.toUri().getPath())
            except FileExistsError:
                return False
            finally:
                self._fs.delete(target, False)
            return True
        return not renamed or self._fs.rename(target, final)

    def roll_back(self) -> None:
        """Forget what was staged, and take up the newest published version."""
        self.step, self.tables = self._read()
        self._last = -1
        for staged, _ in self._moves:
            path = self._path(staged)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        self._moves = []

    # --- upkeep

    def compact(self, name: str) -> None:
        """Stage a table's rows as one part, without deletions."""
        self.stage(name, self.table(name), replace=True)

    def tidy(self, most_parts: int = MOST_PARTS, most_deletions: int = MOST_DELETIONS) -> None:
        """Compact tables of many parts or deletions."""
        for name, t in self.tables.items():
            if len(t["parts"]) > most_parts or len(t["deleted"]) > most_deletions:
                self.compact(name)

    def vacuum(self) -> int:
        """Delete parts that the published version doesn't name, and older versions; how many folders went. Not beside readers of these or runs."""
        step, tables = self._read()
        named = {x["name"] for t in tables.values() for x in (*t["parts"], *t["deleted"])}
        old = [f"{folder}/{part}" for folder in (*TABLES, "_keys") for part in self._names(folder) if part not in named]
        old += [f"_published/{n}" for n in self._names("_published") if n.isdigit() and int(n) < step]
        for path in old:
            self._fs.delete(self._path(f"{self.root}/{path}"), True)
        return len(old)
