"""CSV records of files that are read in splits, quoted line breaks included.

Spark's multi-line CSV mode reads a file in one task. Here a file is read as lines,
in splits, and its records are put together afterwards:

1. Lines land once with their place: file, start of the split in the file
   (``_metadata``) and order inside the split.
2. A line maps the state before it (outside or inside a quoted field) to the state
   after it. Without a quote that is no change; a quote may toggle the state or, if
   it stands inside a bare field, leave it outside. Maps combine, so those of a split
   add up to one (the last line that forgets the state before it, and the toggles
   since), and a scan over the splits of a file (one row each) gives the state in
   which every split begins.
3. A line whose state after it is "outside" ends a record. Lines are numbered by the
   record ends before them; only the lines of records that span lines are grouped
   and joined, all others pass as they are. Where no line opens a field that it does
   not close, every line is a record and no line is shuffled.

Records are numbered in file order, from 0, over the data records of all files (files
by path). The number does not depend on how a file was split. The text is written once,
or twice where records span lines; the result reads what was written last.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import dropping_shuffles, drop_folders, materialize

_SPLIT = ["_file", "_start"]
_OPTIONS = {"escape": '"', "quote": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false", "multiLine": "true", "mode": "PERMISSIVE",
            "maxCharsPerColumn": "-1", "maxColumns": "100000"}


def states_after(line: Column) -> Column:
    """Is a quoted field open at the end of a line? Bit 0: if the line begins outside one, bit 1: if
    inside. A quote opens a field only at its beginning; doubled quotes close nothing. So a part between
    commas with an odd number of quotes toggles the state if it begins with one, else it ends outside; all
    others leave it."""
    def step(states, part):
        quotes = F.length(part) - F.length(F.replace(part, F.lit('"'), F.lit("")))
        return F.when(quotes % 2 == 0, states).when(F.startswith(part, F.lit('"')), states.bitwiseXOR(3)).otherwise(F.lit(0))
    return F.aggregate(F.split(line, ","), F.lit(2), step)


#: About as many bytes of small splits are read by one task.
TASK_BYTES = 128 << 20


@contextmanager
def _splits_of(spark: SparkSession, path, split_bytes):
    """Files are read in splits of at most ``split_bytes``, many of them in a task: there
    are no more tasks than shuffles have, or than the bytes of the files need."""
    if split_bytes is None:
        yield
        return
    total = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(total or 0) // TASK_BYTES))
    settings = {"spark.sql.files.maxPartitionBytes": str(split_bytes), "spark.sql.files.maxPartitionNum": str(tasks)}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def read_lines(spark: SparkSession, path, written: list | None = None, split_bytes=None) -> DataFrame:
    """The lines of a file or folder, written once: _file, _start, _place, line (ended by
    a line feed; a carriage return before it is kept), empty, and out/in: the state after the
    line if it begins outside/inside a quoted field (NULL where it has no quote).
    ``split_bytes``: splits of at most this size instead of the session's."""
    with _splits_of(spark, path, split_bytes):
        lines = (spark.read.option("lineSep", "\n").text(path)
                 .select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
                         F.monotonically_increasing_id().alias("_place"), F.col("value").alias("line")))
        states = F.when(F.contains(F.col("line"), F.lit('"')), states_after(F.col("line")))
        lines = lines.withColumn("empty", F.col("line").isin("", "\r")).withColumn("_states", states)
        return materialize(lines.withColumn("out", F.col("_states").bitwiseAND(1) == 1).withColumn(
            "in", F.col("_states").bitwiseAND(2) == 2).drop("_states"), "csv-lines", written if written is not None else [])


def _running(df: DataFrame, parts: list, order: list, start: Column | None = None):
    """Compose the maps (out, in) along ``order``: adds ``fixed`` (the state, where a
    map forgets the one before) and ``odd`` (how often it was toggled since, mod 2)."""
    w = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    toggles, constant = F.col("out") & ~F.col("in"), F.col("out") == F.col("in")
    df = df.withColumn("_t", F.coalesce(F.sum(toggles.cast("int")).over(w), F.lit(0)))
    last = F.last(F.when(constant, F.struct(F.col("out").alias("state"), F.col("_t").alias("t"))), ignorenulls=True).over(w)
    df = df.withColumn("_l", last)
    return (df.withColumn("fixed", F.col("_l.state"))
            .withColumn("odd", (F.col("_t") - F.coalesce(F.col("_l.t"), F.lit(0))) % 2 == 1).drop("_t", "_l"))


def _state(before: Column, fixed: Column, odd: Column) -> Column:
    return F.coalesce(fixed, before) != odd


def _maps(df: DataFrame) -> DataFrame:
    """(fixed, odd) as a map again: the states after it from outside and from inside."""
    return df.withColumn("out", _state(F.lit(False), F.col("fixed"), F.col("odd"))).withColumn(
        "in", _state(F.lit(True), F.col("fixed"), F.col("odd"))).drop("fixed", "odd")


def _sizes(lines: DataFrame) -> DataFrame:
    """One row a split: its lines, first place, last line that is not empty, lines that
    open a field which they do not close, and the last line that forgets the state before it."""
    forgets = F.col("out") == F.col("in")
    return lines.groupBy(*_SPLIT).agg(
        F.count(F.lit(1)).alias("lines"), F.min("_place").alias("first"), F.max(F.when(~F.col("empty"), F.col("_place"))).alias("full"),
        F.count_if("out").alias("opening"), F.max(F.when(forgets, F.col("_place"))).alias("fixed_at"),
        F.max_by("out", F.when(forgets, F.col("_place"))).alias("fixed"))


def _begins(lines: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row a split: the state in which it begins and that after it."""
    toggles = lines.filter("out AND NOT in").select(*_SPLIT, "_place").join(sizes.select(*_SPLIT, "fixed_at"), _SPLIT)
    odd = toggles.filter("fixed_at IS NULL OR _place > fixed_at").groupBy(*_SPLIT).agg((F.count(F.lit(1)) % 2 == 1).alias("odd"))
    s = sizes.select(*_SPLIT, "first", "fixed").join(odd, _SPLIT, "left").withColumn("odd", F.coalesce("odd", F.lit(False)))
    s = _running(_maps(s), ["_file"], ["_start"])
    w = Window.partitionBy("_file").orderBy("_start")
    s = s.withColumn("after", _state(F.lit(False), F.col("fixed"), F.col("odd")))
    return s.select(*_SPLIT, "first", "after", F.lag("after", 1, False).over(w).alias("begins"))


def _offsets(splits: DataFrame) -> DataFrame:
    """From one row a split (first place, records that end in it, the last of them that is not
    empty): its file (by a number), the records before it in the file and the data
    records of the files before, without headers and empty lines at their ends."""
    up = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    s = splits.withColumn("base", F.coalesce(F.sum("ends").over(up), F.lit(0)))
    files = s.groupBy("_file").agg(F.coalesce(F.max(F.col("base") + F.col("full")), F.lit(0)).alias("last"), F.min("first").alias("file"))
    w = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)     # one row a file
    files = files.select("_file", "file", F.coalesce(F.sum("last").over(w), F.lit(0)).alias("before"))
    return s.join(files, "_file").select(*_SPLIT, "first", "file", "base", "before")


def read_records(spark: SparkSession, path, written: list | None = None, split_bytes=None) -> DataFrame:
    """(file, record, number, line): the text of every record, the header of each file included,
    with its number in its file (and the file's) and over the data records of all files. Runs jobs: the lines
    are written first. ``written`` gets the folders that the result reads."""
    written = written if written is not None else []
    made: list = []
    lines = read_lines(spark, path, made, split_bytes)
    sizes = materialize(_sizes(lines), "csv-sizes")
    record = F.col("base") + F.col("ended")
    columns = ["file", record.alias("record"), (F.col("before") + record - 1).alias("number")]
    if sizes.filter("opening > 0").limit(1).count() == 0:           # every line is a record
        written += made
        at = materialize(_offsets(sizes.select(*_SPLIT, "first", F.col("lines").alias("ends"), (F.col("full") - F.col("first")).alias("full"))),
                         "csv-splits")
        placed = lines.select(*_SPLIT, "_place", "line").join(at, _SPLIT).withColumn("ended", F.col("_place") - F.col("first"))
        return placed.select(*columns, _trimmed(F.col("line")).alias("line"))
    splits = materialize(_begins(lines, sizes), "csv-states")
    # one row a file: a quoted field that nothing closes
    ends = splits.groupBy("_file").agg(F.max_by("after", "_start").alias("open")).filter("open").select("_file").head(1)
    if ends:
        drop_folders(spark, made)
        raise ValueError(f"{ends[0]['_file']}: a quoted field is not closed")
    w = Window.partitionBy("first").orderBy("_place")
    placed = _running(lines.join(splits.select(*_SPLIT, "first", "begins"), _SPLIT).drop("_file"), ["first"], ["_place"])
    placed = (placed.withColumn("inside", _state(F.col("begins"), F.col("fixed"), F.col("odd")))
              .withColumn("was", F.coalesce(F.lag("inside").over(w), F.col("begins")))
              .withColumn("ended", F.coalesce(F.sum((~F.col("inside")).cast("long")).over(
                  w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    placed = materialize(placed.select("first", "_start", "_place", "line", "empty", "inside", "was", "ended"), "csv-places", written)
    drop_folders(spark, made)
    ends = placed.groupBy("first").agg(F.count_if(~F.col("inside")).alias("ends"), F.max(
        F.when(F.col("inside") | F.col("was") | ~F.col("empty"), F.col("ended"))).alias("full"))
    at = materialize(_offsets(splits.select(*_SPLIT, "first").join(ends, "first")), "csv-splits")
    placed = placed.join(at.drop(*_SPLIT), "first")
    alone = placed.filter("NOT inside AND NOT was").select(*columns, "line")
    spread = (placed.filter("inside OR was").select(*columns, "_start", "_place", "line").groupBy("file", "record", "number")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_start", "_place", "line"))), lambda x: x["line"]),
                                "\n").alias("line")))
    return alone.unionByName(spread).withColumn("line", _trimmed(F.col("line")))


def _trimmed(line: Column) -> Column:
    """A record without the carriage return of a CR LF line end."""
    return F.when(F.endswith(line, F.lit("\r")), F.expr("left(line, length(line) - 1)")).otherwise(line)


@dropping_shuffles
def read_text_table(spark: SparkSession, path, seq_col: str | None = None, written: list | None = None, split_bytes=None) -> DataFrame:
    """All columns of a CSV file, or a folder of files with one header, as text,
    unchanged; ``seq_col``: the number of the record over all files. Empty lines are
    no records. Runs jobs. ``written`` gets the folders that the result reads, for
    ``drop_folders`` when it has been consumed."""
    records = read_records(spark, path, written, split_bytes)
    heads = [r["line"] for r in records.filter("record = 0").select(
        F.regexp_replace("line", "^﻿", "").alias("line")).distinct().limit(2).collect()]
    if len(heads) != 1:
        raise ValueError(f"{path}: " + ("no header" if not heads else f"files with different headers {heads}"))
    names = spark.range(1).select(F.from_csv(F.lit(heads[0]), _columns(1000, heads[0]), _OPTIONS).alias("r")).first()["r"]
    names = [n for n in names if n is not None]
    data = records.filter("record > 0 AND line <> ''").withColumn("_cells", F.from_csv("line", _ddl(names), _OPTIONS))
    return data.select("_cells.*", *([F.col("number").alias(seq_col)] if seq_col else []))


def _ddl(names) -> str:
    return ", ".join("`" + n.replace("`", "``") + "` string" for n in names)


def _columns(most: int, head: str) -> str:
    """Names for as many columns as a header can have."""
    return _ddl([f"c{i}" for i in range(min(most, head.count(",") + 1))])
