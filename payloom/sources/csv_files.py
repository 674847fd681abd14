"""CSV files: parallel raw scan with record numbers, content hashes, quarantine and export sinks."""

from __future__ import annotations

import codecs
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payloom.schemas import RAW_COLUMNS

#: A quote inside a quoted field is doubled; a backslash is a character like any other.
FORMAT = {"escape": '"'}


def _odd(n: Column) -> Column:
    return n % 2 == 1


def _ends_inside(line: Column, inside: bool) -> Column:
    """Whether a line ends inside quotes, if it starts inside them or not. A quote opens a field at its very start only, and after a field is closed, what follows up to the comma is its own."""
    closes = lambda text: F.contains(F.replace(text, F.lit('""'), F.lit("")), F.lit('"'))
    step = lambda state, piece: F.when(state, ~closes(piece)).otherwise(piece.startswith('"') & ~closes(F.substring(piece, F.lit(2), F.length(piece))))
    return F.aggregate(F.split(line, ","), F.lit(inside), step)


def _after(start: Column, change: Column) -> Column:
    """The state behind a change (fixed, to): a fixed one ends in `to` wherever it starts, another turns the state round if `to`."""
    return F.when(change["fixed"], change["to"]).otherwise(start != change["to"])


def _composed(change: Column, upto: Window) -> Column:
    """All changes of a window of rows as one: the last fixed one, and how often the state is turned round after it."""
    turns = F.sum(F.when(~change["fixed"] & change["to"], 1).otherwise(0)).over(upto)
    last = F.last(F.when(change["fixed"], F.struct(change["to"].alias("to"), change["turns"].alias("turns"))), ignorenulls=True).over(upto)
    turned = F.when(last.isNotNull(), last["to"] != _odd(turns - last["turns"])).otherwise(_odd(turns))
    return F.struct(last.isNotNull().alias("fixed"), turned.alias("to"))


def _with_turns(rows: DataFrame, change: Column, upto: Window) -> DataFrame:
    turns = F.sum(F.when(~change["fixed"] & change["to"], 1).otherwise(0)).over(upto)
    return rows.withColumn("change", F.struct(change["fixed"].alias("fixed"), change["to"].alias("to"), turns.alias("turns")))


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source_path, source_row, record): the text of each record of CSV files and its number, where the header is 1. Blank lines between records are none.

    Files are cut into blocks of lines, which tasks read in parallel. Whether a block starts inside a quoted field isn't known to its task; so each line is a change of that state, for
    both ways it may start, changes are composed along a block, and along the blocks of a file, one row each. With the state at its start, each block tells its records,
    and counts of records of the blocks before number them. Only records of several lines are put together by a shuffle."""
    scanned = spark.read.option("lineSep", "\n").text(path)
    lines = scanned.select(F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    quoted = F.contains("value", F.lit('"'))
    outside, inside = F.when(quoted, _ends_inside(F.col("value"), False)).otherwise(False), F.when(quoted, _ends_inside(F.col("value"), True)).otherwise(True)
    lines = lines.withColumns({"outside": outside, "inside": inside})

    order = Window.partitionBy("source_path", "block").orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = _with_turns(lines, F.struct((F.col("outside") == F.col("inside")).alias("fixed"), F.col("outside").alias("to")), upto)
    none = F.struct(F.lit(False).alias("fixed"), F.lit(False).alias("to"))
    lines = lines.withColumn("after", _composed(F.col("change"), upto)).withColumn("before", F.coalesce(F.lag("after").over(order), none))
    filled = ~F.col("value").isin("", "\r")
    starts = {x: (~_after(F.lit(x), F.col("before")) & filled).cast("long") for x in (False, True)}
    lines = lines.withColumns({"n_outside": F.sum(starts[False]).over(upto), "n_inside": F.sum(starts[True]).over(upto)})
    lines = lines.select("source_path", "block", "at", "value", "before", "after", "n_outside", "n_inside")

    blocks = lines.groupBy("source_path", "block").agg(F.max_by(F.struct("after", "n_outside", "n_inside"), "at").alias("b")).select("source_path", "block", "b.*")
    order = Window.partitionBy("source_path").orderBy("block")  # a row for each block
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = _with_turns(blocks, F.col("after"), upto).withColumn("upto", _composed(F.col("change"), upto))
    blocks = blocks.withColumn("starts_inside", _after(F.lit(False), F.coalesce(F.lag("upto").over(order), none)))
    own = F.when(F.col("starts_inside"), F.col("n_inside")).otherwise(F.col("n_outside"))
    blocks = blocks.select("source_path", "block", "starts_inside", (F.sum(own).over(upto) - own).alias("earlier"))

    placed = lines.join(blocks, ["source_path", "block"])
    state = F.col("starts_inside")
    number = F.col("earlier") + F.when(state, F.col("n_inside")).otherwise(F.col("n_outside"))
    placed = placed.select("source_path", "block", "at", "value", number.alias("source_row"), _after(state, F.col("before")).alias("opened"), _after(state, F.col("after")).alias("open"))
    whole = placed.where(~F.col("opened") & ~F.col("open") & filled).select("source_path", "source_row", F.col("value").alias("record"))
    parts = placed.where(F.col("opened") | F.col("open")).groupBy("source_path", "source_row").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts"))
    joined = parts.select("source_path", "source_row", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"))
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of a file's first record. Of equal names only the first keeps it; blank ones are named by their place."""
    found, seen = [], set()
    first = spark.read.options(header=False, multiLine=True, **FORMAT).csv(path).first()
    for i, name in enumerate(first or ()):
        name = name if name and name.lower() not in seen else f"_c{i}"
        seen.add(name.lower())
        found.append(name)
    return found


def read_raw(spark: SparkSession, *paths: str) -> DataFrame:
    """All columns as text, blanks empty, with source_file, source_row (the record's number in its file, where the header is 1) and file, the number of the file among the paths, from 0.
    Columns go by each file's own header; those a file lacks are null."""
    numbers, headers = {}, {}
    for i, p in enumerate(paths):
        numbers[_plain(_status(spark, p).getPath().toUri().toString())] = i
        headers.setdefault(tuple(header_of(spark, p)), []).append(p)
    named = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    name = F.url_decode(F.replace(F.element_at(F.split("source_path", "/"), -1), F.lit("+"), F.lit("%2B")))
    frames = []
    for header, group in headers.items():
        if not header:  # empty files
            continue
        records = read_records(spark, group).where("source_row > 1")
        fields = F.from_csv("record", ", ".join(f"`{c.replace('`', '``')}` string" for c in header), FORMAT)
        place = [name.alias("source_file"), F.col("source_row").cast("int").alias("source_row"), F.try_element_at(named, F.regexp_replace("source_path", "^file:/+", "file:/")).alias("file")]
        rows = records.select(fields.alias("f"), *place).select("f.*", "source_file", "source_row", "file")
        frames.append(rows.withColumns({c: F.coalesce(c, F.lit("")) for c in header if c in RAW_COLUMNS}))
    if not frames:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", source_file string, source_row int, file int")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def _plain(uri: str) -> str:
    return re.sub("^file:/+", "file:/", uri)


def _status(spark: SparkSession, path: str):
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(file)


def file_hashes(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """SHA-256 of each file's bytes, by path. Lines are read by all tasks through Spark's own reader, so from any store it reads, and one task for each file puts them
    through the hash in order, a batch at a time; the driver gets the digests only.

    The reader leaves out line ends, and the mark of UTF-8 at the start of a file; a file's size tells whether its last line has an end, and whether there is a mark."""
    status = {p: _status(spark, p) for p in paths}
    uri = {p: _plain(status[p].getPath().toUri().toString()) for p in paths}
    full = {uri[p]: status[p].getPath().toString() for p in paths if status[p].getLen()}
    found = {}
    if full:
        scanned = spark.read.option("lineSep", "\n").text(list(full.values()))
        lines = scanned.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("line"))
        ends = lines.groupBy("path").agg(F.sum(F.octet_length("line") + 1).alias("ended"), F.count("*").alias("n"))
        told = lines.join(ends, "path").withColumn("lacks", F.col("size") - F.col("ended"))
        in_order = told.repartition(len(full), "path").sortWithinPartitions("path", "block", "at").select("path", "line", "n", "lacks")

        def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums, seen = {}, Counter()
            for batch in batches:
                for path, rows in batch.groupby("path", sort=False):
                    n, lacks = rows["n"].iat[0], rows["lacks"].iat[0]
                    if path not in sums:
                        sums[path] = hashlib.sha256(codecs.BOM_UTF8 if lacks >= 2 else b"")
                    seen[path] += len(rows)
                    sums[path].update(b"\n".join(rows["line"]) + (b"\n" if seen[path] < n or lacks in (0, 3) else b""))
            yield pd.DataFrame({"path": list(sums), "digest": [s.hexdigest() for s in sums.values()]}, dtype=str)

        found = {_plain(r["path"]): r["digest"] for r in in_order.mapInPandas(digest, "path string, digest string").collect()}  # a row for each file
    # a file without a line is empty, or nothing but the mark
    return {p: found.get(uri[p]) or hashlib.sha256(codecs.BOM_UTF8 if uri[p] in full else b"").hexdigest() for p in paths}


def write_quarantine(rejects: DataFrame, folder: str) -> None:
    """The rejected rows with their reasons, in file order."""
    rejects.orderBy("source_row").write.mode("overwrite").options(header=True, **FORMAT).csv(folder)


def export(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").options(header=True, **FORMAT).csv(path)
