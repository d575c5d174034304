"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

#: Text handled at once inside a Python task; a single longer text is handled alone.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table below ``spark.checkpoint.dir`` and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as ''."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def slices(values: list, size: int = SLICE_BYTES):
    """(start, stop) ranges over texts, each of about ``size`` characters at most."""
    start, held = 0, 0
    for i, v in enumerate(values):
        n = len(v) if v is not None else 0
        if held and held + n > size:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(values):
        yield start, len(values)


def sha256_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
