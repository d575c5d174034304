"""Written stages with a manifest each, so that a restart trusts whole and current stages only.

A stage is written as Parquet and its counts are observed in the same job.  Its
manifest (one JSON row) is committed behind it: the mark of what it was made
from, the mark of its own files, its schema and its counts.  A stage whose
writer died has no manifest that fits its files; one whose inputs or settings
have changed since has another input mark.  Both are run again.  Changes of the
library's code are not seen.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MANIFEST = "inputs string, files string, schema string, counts string"


def mark(*parts: object) -> str:
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()


def _listing_mark(listing: DataFrame) -> str:
    """Number, bytes and a hash of names, lengths and times of files; their content is not read."""
    got = listing.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"),
                      F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("hash")).first()
    return mark(got.n, got.bytes, got.hash)


def files_mark(spark: SparkSession, path: str) -> str | None:
    """Mark of the files below ``path``; None where there is no such folder."""
    try:
        return _listing_mark(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def input_mark(spark: SparkSession, df: DataFrame) -> str:
    """Mark of an input table: its files and its schema, or its plan if it is not read from files."""
    files = [unquote(f) for f in df.inputFiles()]
    content = _listing_mark(spark.read.format("binaryFile").load(files)) if files else df.semanticHash()
    return mark(content, df.schema.json())


class Stages(dict):
    """Stage name -> path of what was written or found valid; ``counts`` holds each stage's counts, ``ran`` the stages run."""

    def __init__(self, spark: SparkSession, base: str):
        super().__init__()
        self.spark, self.base = spark, base.rstrip("/")
        self.counts: dict[str, dict[str, int]] = {}
        self.marks: dict[str, str] = {}
        self.ran: list[str] = []

    def _manifest(self, name: str):
        try:
            return self.spark.read.schema(MANIFEST).json(f"{self.base}/manifests/{name}").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _whole(self, name: str, schema: StructType):
        """The manifest of the written stage if that is whole, made from the same and of ``schema``; else None."""
        found = self._manifest(name)
        if (found is None or (found.inputs, found.schema) != (self.marks[name], schema.json())
                or found.files != files_mark(self.spark, f"{self.base}/{name}")):
            return None
        return found

    def save(self, name: str, df: DataFrame, made_from: Sequence[object], keep: bool = False, partition_by: str | None = None,
             counts: dict[str, Column] | None = None, observed: dict[str, Observation] | None = None) -> DataFrame:
        """The stage read back from its files.

        ``made_from`` are the marks and settings that decide its content.  With
        ``keep`` a valid stage is left as it is.  ``counts`` are aggregates over
        the written rows besides ``n_rows``; ``observed`` are observations that
        ``df`` holds further up, whose metrics are prefixed by their key.
        """
        path = f"{self.base}/{name}"
        self[name], self.marks[name] = path, mark(name, *made_from)
        if partition_by:  # last, where files of a partitioned table have it
            df = df.select(*[c for c in df.columns if c != partition_by], partition_by)
        kept = self._whole(name, df.schema) if keep else None
        if kept is not None:
            self.counts[name] = json.loads(kept.counts)
            return self.spark.read.schema(df.schema).parquet(path)
        written = Observation()
        rows = df.observe(written, F.count(F.lit(1)).alias("n_rows"), *[c.alias(k) for k, c in (counts or {}).items()])
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        found = dict(written.get)
        for prefix, observation in (observed or {}).items():
            found.update({prefix + k: v for k, v in observation.get.items()})
        self.counts[name] = found
        row = (self.marks[name], files_mark(self.spark, path), df.schema.json(), json.dumps(found))
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.base}/manifests/{name}")
        self.ran.append(name)
        # Given the schema, as a partitioned table without rows has no file to read it from.
        return self.spark.read.schema(df.schema).parquet(path)
