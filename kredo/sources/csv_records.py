"""CSV with quoted newlines, read by many tasks.

Spark reads a file of quoted newlines (``multiLine``) in one task.  Here the file is read as lines, which
can be split anywhere.  A line begins a record where the quotes before it in its file are even in number, so
a running total of the quotes tells the records; only the lines of records of several lines are grouped.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kredo.operators.ranges import running_total

#: Characters of the longest record that is put together from lines.
LONGEST = 64 << 20
#: Pieces that a scan split (128 MB unless set otherwise) is sorted in, so that a task's sort keeps its size.
PIECES = 4


def _first_places(rows: DataFrame) -> DataFrame:
    """(file, place) of the first row of each file.  Numbers by block first: the smallest of structs would be found by a sort."""
    blocks = rows.groupBy("file", F.col("place.block").alias("block")).agg(F.min("place.row").alias("row"))
    return blocks.groupBy("file").agg(F.min(F.struct("block", "row")).alias("place"))


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """The lines of all files with their place in the file; bytes are decoded here, since text files are read as they are."""
    text = spark.read.option("lineSep", "\n").text(path)
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    lines = text.select(F.col("_metadata.file_path").alias("file"), place.alias("place"),
                        F.decode(F.col("value").cast("binary"), encoding).alias("line"))
    return lines.withColumn("quotes", F.length("line") - F.length(F.translate("line", '"', "")))


def _ended(c: str) -> Column:
    """The text without the first half of a line's end of two characters."""
    return F.regexp_replace(c, r"\r\z", "")


def _strict(record: Column) -> Column:
    """Quotes stand only around whole fields (a doubled one inside is two runs side by side)."""
    shape = F.regexp_replace(record, '(?:"[^"]*+")++', "\u0001")
    return ~shape.contains('"') & ~shape.rlike("[^,]\u0001|\u0001[^,]")


def read_csv(spark: SparkSession, path: str, options: dict[str, str], longest: int = LONGEST) -> DataFrame:
    """The rows that ``spark.read.options(**options).csv(path)`` gives, all columns text, read by many tasks.

    ``options`` are those of a file with a header, commas, doubled quotes and ``multiLine``, in an encoding that
    keeps a quote and a newline as one byte.  Every file has a header; the names are those of the first.
    A file's first line tells how its lines end (a newline, with a carriage return or without).  Blank lines are
    skipped, short rows filled with NULLs, extra values left out.  The count of quotes finds the records
    only if quotes stand around whole fields.  This is checked on every record: a path with a file that breaks it
    (a quote inside a plain field, one that is never closed), with lines that end in a carriage return alone, or
    with a record of more than ``longest`` characters is read by Spark's reader as a whole, with a warning.
    A folder without rows gives no rows.
    """
    whole = spark.read.options(**options).csv(path)
    lines = _lines(spark, path, options.get("encoding", "UTF-8"))
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions")), PIECES * lines.rdd.getNumPartitions())
    counted = running_total(lines, ["file"], "place", "quotes", "upto", pieces)
    # One row a file, so broadcast: a join on the file would bring each file's lines to one task.
    heads = counted.join(F.broadcast(_first_places(counted)), ["file", "place"]).select("file", F.col("line").alias("head"))
    heads = heads.select("file", F.col("head").endswith("\r").alias("crlf"), _ended("head").contains("\r").alias("odd"))
    counted = counted.join(F.broadcast(heads), "file")
    if not counted.where(F.col("odd") | (~F.col("crlf") & F.col("line").startswith("\r"))).isEmpty():
        warnings.warn(f"{path}: lines that end in a carriage return alone; read by one task a file", stacklevel=2)
        return whole
    begins = (F.col("upto") - F.col("quotes")) % 2 == 0
    line = F.when(F.col("crlf"), _ended("line")).otherwise(F.col("line"))
    lines = counted.select("file", "place", line.alias("line"), begins.alias("begins"), (F.col("upto") % 2 == 0).alias("ends"))
    lines = lines.where(~F.col("begins") | (F.col("line") != ""))
    single = lines.where(F.col("begins") & F.col("ends")).select("file", "place", F.col("line").alias("record"))
    parts = lines.where(~(F.col("begins") & F.col("ends"))).withColumn("begin", F.col("begins").cast("int"))
    numbered = running_total(parts, ["file"], "place", "begin", "number", pieces)
    sizes = numbered.groupBy("file", "number").agg(F.sum(F.length("line") + 1).alias("size"))
    if (sizes.agg(F.max("size")).first()[0] or 0) > longest:
        warnings.warn(f"{path}: a record is longer than {longest} characters; read by one task a file", stacklevel=2)
        return whole
    several = numbered.repartition(pieces, "file", "number").groupBy("file", "number").agg(
        F.min("place").alias("place"), F.array_sort(F.collect_list(F.struct("place", "line"))).alias("all"))
    records = single.unionByName(several.select("file", "place", F.array_join("all.line", "\n").alias("record")))
    if not records.where(~_strict(F.col("record"))).isEmpty():
        warnings.warn(f"{path}: quotes inside a plain field or never closed; read by one task a file", stacklevel=2)
        return whole
    headers = F.broadcast(_first_places(records))
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in whole.columns)
    rows = records.join(headers, ["file", "place"], "left_anti").select(F.from_csv("record", schema, options).alias("_row"))
    return rows.select("_row.*")
