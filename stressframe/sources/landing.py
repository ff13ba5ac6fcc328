"""CSV folders whose files have differing headers (SRC-1, SRC-2).

Every file is read by its own header: files with the same header line form a group,
a group is read with exactly that header, and groups are united by column name, so
column order and missing columns do not matter.  A cell that its column's type cannot
read becomes NULL and is kept, with its file and row, in a quarantine table; so is a
row with more or fewer cells than its file's header.

Finding the headers is one pass over the text in which a task keeps one line a file.
The driver holds the file names by header, as it does when it lists a folder.

Results in special cases: an empty file has no header and no rows; a file with a
header only has no rows; names are matched without white space around them, a byte
order mark before the first one goes; a header that names a column twice is an error;
columns that the schema does not know are kept as text unless ``extra`` is False; a
schema column that no file has is NULL (or absent without ``fill``); the text ``nan`` is a missing value.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stressframe.functions.columns import nan_to_null_all

BAD_ROW = "_bad_row"
FILE = "source_file"
QUARANTINE = "source_file string, column string, value string, row string"


def headers(spark: SparkSession, path: str) -> DataFrame:
    """(header, files): the first line of every file, with the files that have it."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("s"))
    first = lines.where("s = 0").withColumn("k", F.monotonically_increasing_id()).groupBy("f").agg(F.min_by("value", "k").alias("header"))
    return first.groupBy("header").agg(F.sort_array(F.collect_list("f")).alias("files"))


def column_names(header: str) -> list[str]:
    """Names of a header line (quoted or not), trimmed."""
    import csv

    names = [n.strip() for n in next(csv.reader([header.lstrip("﻿")]))]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"header names a column twice: {', '.join(twice)}")
    return names


def _group(spark: SparkSession, names: list[str], files: list[str]) -> DataFrame:
    """Rows of files with one header, all cells as text, with file and spoiled rows."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, BAD_ROW]])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnPruning", False)
    return reader.option("columnNameOfCorruptRecord", BAD_ROW).csv(files).withColumn(FILE, F.col("_metadata.file_path"))


def read_landing(
    spark: SparkSession, path: str, schema: T.StructType, extra: bool = True, fill: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of a CSV folder.

    ``rows``: the schema's columns (with ``fill`` also those no file has), then unknown
    ones as text (with ``extra``), then ``source_file``.  ``quarantine``: (source_file, column, value, row); a row whose
    number of cells is wrong appears once with column NULL and is not among the rows."""
    found = headers(spark, path).orderBy("header").collect()
    known = {f.name: f.dataType for f in schema.fields}
    groups, bad = [], []
    for header, files in found:
        names = column_names(header)
        raw = _group(spark, names, files)
        # true for every row, but it reads a cell: Spark refuses to read the spoiled text alone
        reads = F.xxhash64(F.col(f"`{names[0]}`")) >= F.lit(-(1 << 63))
        fine = raw.where(F.col(BAD_ROW).isNull() & reads)
        typed = [F.col(f"`{n}`").try_cast(known[n]).alias(n) if n in known else F.col(f"`{n}`") for n in names if n in known or extra]
        groups.append(fine.select(*typed, FILE))
        cells = [
            F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("value"), (F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(known[n]).isNull()).alias("b"))
            for n in names
            if n in known and not isinstance(known[n], T.StringType)
        ]
        whole = F.to_json(F.struct(*[F.col(f"`{n}`") for n in names]))
        if cells:
            spoiled = fine.select(FILE, F.inline(F.array(*cells)), whole.alias("row")).where("b").drop("b")
            bad.append(spoiled.select(FILE, "column", "value", "row"))
        none = F.lit(None).cast("string")
        bad.append(raw.where(F.col(BAD_ROW).isNotNull() & reads).select(FILE, none.alias("column"), none.alias("value"), F.col(BAD_ROW).alias("row")))
    if not groups:
        empty = T.StructType([*schema.fields, T.StructField(FILE, T.StringType())])
        return spark.createDataFrame([], empty), spark.createDataFrame([], QUARANTINE)
    union = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)
    there = [F.col(n) if n in union.columns else F.lit(None).cast(t).alias(n) for n, t in known.items() if fill or n in union.columns]
    others = [n for n in union.columns if n not in known and n != FILE]
    rows = union.select(*there, *[F.col(f"`{n}`") for n in others], FILE)
    return nan_to_null_all(rows), functools.reduce(DataFrame.unionAll, bad)
