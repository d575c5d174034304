"""Feeds and registers read from CSV files, in the shape that ``fixtures`` gives them.

Columns are found by header name: blanks around a name go, and of a dotted
name (``RegAddress.PostTown``) the last part stays.  Only the wanted columns
are kept, with declared types; a value that is none of its type is null, and so
is a wanted column that the file lacks.  Nothing is inferred from the data.

Quotes inside quoted fields are doubled.  ``multi_line`` allows line breaks in
fields, but then a file cannot be split and is read by one task: give large
feeds as many files, or turn it off where no field has a line break.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..operators.payments import NHS_ID_COLUMNS

CENTGOV_LABEL = "Contracts Finder"  # as the reference labels it
NHS_LABEL = "NHSSpend"
AWARDS_LABEL = "Contracts Finder"

PAYMENT = {"amount": "double", "supplier": "string", "date": "string", "dept": "string"}
NHS = {**PAYMENT, **{c: "string" for c in NHS_ID_COLUMNS}}
AWARDS = {"awardedDate": "string", "awardedSupplier": "string", "awardedValue": "double",
          "organisationName": "string", "awardedToVcse": "boolean", "region": "string"}
COMPANY = {"CompanyName": "string", "CompanyNumber": "string", "PostTown": "string", "PostCode": "string"}
SPINE = {c: "string" for c in ("uid", "organisationname", "fulladdress", "city", "postcode", "registerdate", "removeddate")}
NHS_LIST = {"NHSDigital_Supplier": "string"}


def clean_header(name: str) -> str:
    return name.strip().rsplit(".", 1)[-1].strip()


def read_csv(spark: SparkSession, path: str, columns: dict[str, str], multi_line: bool = True) -> DataFrame:
    """``columns`` (name -> type) of a CSV file, or of a folder's files, with a header; ``__row`` numbers the rows.

    Rows are numbered from zero by file path, then by place in the file, however
    Spark packs files and parts of files into tasks.
    """
    raw = spark.read.options(header=True, escape='"', multiLine=multi_line, inferSchema=False).csv(path)
    found = {}
    for at, name in enumerate(raw.columns):
        found.setdefault(clean_header(name), at)
    plain = raw.select("*", "_metadata.file_path", "_metadata.file_block_start").toDF(
        *[f"c{i}" for i in range(len(raw.columns))], "__file", "__block")
    wanted = [(F.col(f"c{found[c]}").try_cast(kind) if c in found else F.lit(None).cast(kind)).alias(c)
              for c, kind in columns.items()]
    rows = plain.select(*wanted, "__file", "__block", F.monotonically_increasing_id().alias("__id"))
    # The rows of a part of a file follow each other in one task; a light pass counts them.
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    parts = (rows.groupBy("__file", "__block").agg(F.min("__id").alias("__least"), F.count(F.lit(1)).alias("n"))
             .withColumn("__before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    # One row per file, or per part of a large one (128 MB by default).
    return (rows.join(F.broadcast(parts), ["__file", "__block"])
            .select(*columns, (F.col("__before") + F.col("__id") - F.col("__least")).alias("__row")))


def _feed(spark: SparkSession, paths: list[str], columns: dict[str, str], label: str, feed_ord: int,
          multi_line: bool) -> DataFrame:
    """The files one after the other, with ``data_source`` and the keys of a payment's position."""
    parts = [read_csv(spark, p, columns, multi_line).select(
        F.lit(label).alias("data_source"), *columns, F.lit(feed_ord).alias("feed_ord"),
        F.lit(i).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"),
        F.col("__row").alias("k3"), F.lit(0).cast("long").alias("k4")) for i, p in enumerate(paths)]
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def nhs(spark: SparkSession, *paths: str, label: str = NHS_LABEL, multi_line: bool = True) -> DataFrame:
    return _feed(spark, list(paths), NHS, label, 0, multi_line)


def centgov(spark: SparkSession, *paths: str, label: str = CENTGOV_LABEL, multi_line: bool = True) -> DataFrame:
    return _feed(spark, list(paths), PAYMENT, label, 1, multi_line)


def awards(spark: SparkSession, *paths: str, label: str = AWARDS_LABEL, multi_line: bool = True) -> DataFrame:
    return _feed(spark, list(paths), AWARDS, label, 2, multi_line)


def company(spark: SparkSession, current: str, *history: str, multi_line: bool = True) -> DataFrame:
    """The current company register and older part files, which count behind it in the order given."""
    return _union([read_csv(spark, p, COMPANY, multi_line)
                   .select(*COMPANY, F.lit(i).alias("src_priority"), F.col("__row").alias("k1"))
                   for i, p in enumerate([current, *history])])


def spine(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_csv(spark, path, SPINE, multi_line).withColumnRenamed("__row", "k1")


def nhs_list(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return read_csv(spark, path, NHS_LIST, multi_line).withColumnRenamed("__row", "k1")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header; arrays become JSON text, quotes inside fields are doubled."""
    cols = [F.to_json(f.name, {"ignoreNullFields": "false"}).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name)
            for f in df.schema.fields]
    df.select(*cols).write.mode("overwrite").options(header=True, escape='"').csv(path)


def from_json_text(text: str | None) -> list | None:
    """An array of ``write_csv`` read back, for callers outside Spark."""
    return None if text is None else json.loads(text)
