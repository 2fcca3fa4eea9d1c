"""CSV interchange files: typed reader, rejects, writer, and the load into the warehouse."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegralType, StringType, StructField, StructType

from martlight.schemas import TABLES
from martlight.session import hadoop_path
from martlight.sources.warehouse import replace_partitions, write_files

_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    # The writer would strip the ends of text by default.
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_BROKEN = "_broken_record"
# First lines the driver reads at a time; each is one short round trip to the file system.
_HEADERS_AT_ONCE = 32


def _typed(text: Column, kind: DataType) -> Column:
    """Parse a CSV field; text that does not fit the type becomes NULL."""
    if isinstance(kind, ArrayType):
        # A JSON list, or a list literal with single or double quotes around each item.
        return F.from_json(text, kind, {"allowSingleQuotes": "true"})
    if isinstance(kind, IntegralType):
        # A nullable integer comes as 3.0; any other fraction is no integer. Digits that are written as their
        # own value are, which is most of a file; only other text is matched.
        digits = F.when(F.endswith(text, F.lit(".0")), F.substr(text, F.lit(1), F.length(text) - 2)).otherwise(text)
        value = digits.try_cast(kind)
        whole = F.regexp_extract(text, r"^\s*([+-]?\d+)(\.0*)?\s*$", 1)
        return F.when(value.cast("string") == digits, value).otherwise(whole.try_cast(kind))
    return text.try_cast(kind)


def _header(spark: SparkSession, file: str) -> tuple[str, ...]:
    """Column names in a file's first line; none if it is empty."""
    path, files = hadoop_path(spark, file)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(files.open(path), "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return tuple(next(csv.reader([line.removeprefix("﻿")]))) if line else ()


def _records(spark: SparkSession, path: str, name: str, multi_line: bool) -> DataFrame:
    """Declared columns as text and ``_broken_record``, the record if it has not its header's width.

    Every file is read by its own header, so files may order their columns differently or lack
    some; files of one header are read together.
    """
    declared = TABLES[name].schema.fieldNames()
    groups: dict[tuple[str, ...], list[str]] = {}
    files = spark.read.options(**_OPTIONS).schema("line string").csv(path).inputFiles()
    with ThreadPoolExecutor(_HEADERS_AT_ONCE) as pool:
        for file, header in zip(files, pool.map(lambda f: _header(spark, f), files)):
            groups.setdefault(header, []).append(file)
    parts = []
    for header, files in groups.items():
        if not header:
            continue
        if missing := {f.name for f in TABLES[name].schema if f.name in TABLES[name].partition_by} - set(header):
            raise ValueError(f"{name}: no column {', '.join(sorted(missing))} in {files[0]}")
        schema = StructType([StructField(c, StringType()) for c in [*header, _BROKEN]])
        reader = spark.read.schema(schema).options(
            **_OPTIONS, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN, columnPruning=False
        )
        columns = [F.col(c) if c in header else F.lit(None).cast("string").alias(c) for c in declared]
        parts.append(reader.csv(files).select(*columns, _BROKEN))
    if not parts:
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in [*declared, _BROKEN]]))
    return reduce(DataFrame.union, parts)


def read_csv(spark: SparkSession, path: str, name: str, multi_line: bool = False) -> DataFrame:
    """Read CSV files of a declared table, matching columns by each file's header.

    ``multi_line`` allows line breaks inside quoted fields (a file is then one task's work). Records
    of the wrong width are left out, fields that don't fit their type are NULL; ``rejects`` has both.
    """
    spec = TABLES[name]
    text = _records(spark, path, name, multi_line)
    # Spark reads no file for its broken records alone, as a plain count would ask it to.
    any_field = F.length(F.concat_ws("", F.col(spec.schema.fieldNames()[0]))) >= 0
    text = text.where(F.col(_BROKEN).isNull() & any_field)
    return text.select([_typed(F.col(f.name), f.dataType).alias(f.name) for f in spec.schema])


def rejects(spark: SparkSession, path: str, name: str, multi_line: bool = False) -> DataFrame:
    """(column_name, value) of every field that its type cannot hold, and (NULL, record) of records of the wrong width."""
    text = _records(spark, path, name, multi_line)
    broken = F.col(_BROKEN).isNotNull()

    def cell(f: StructField) -> Column:
        bad = ~broken & F.col(f.name).isNotNull() & _typed(F.col(f.name), f.dataType).isNull()
        return F.when(bad, F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("value")))

    whole = F.when(broken, F.struct(F.lit(None).cast("string").alias("column_name"), F.col(_BROKEN).alias("value")))
    cells = F.filter(F.array(whole, *[cell(f) for f in TABLES[name].schema]), lambda x: x.isNotNull())
    return text.select(F.inline(cells))


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Number of rejects per column; column_name is NULL for records of the wrong width."""
    return rejected.groupBy("column_name").agg(F.count(F.lit(1)).alias("rejected"))


def write_csv(df: DataFrame, path: str) -> None:
    """Write CSV files with a header; arrays become JSON lists."""
    fields = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name) for f in df.schema
    ]
    df.select(fields).write.mode("overwrite").options(**_OPTIONS).csv(path)


def load_csv(
    spark: SparkSession, csv_path: str, name: str, warehouse_path: str, replace_all: bool = True, multi_line: bool = False
) -> None:
    """Load CSV files into the table's folder: all of it, or only the partitions they contain.

    A table without partitions is always replaced.
    """
    rows = read_csv(spark, csv_path, name, multi_line)
    if replace_all or not TABLES[name].partition_by:
        write_files(rows, name, warehouse_path)
    else:
        replace_partitions(rows, name, warehouse_path)
