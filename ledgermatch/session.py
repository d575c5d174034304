"""Spark session helpers.

Library code never creates its own session; it takes the one it is given.
``local_session`` exists for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for every job in this package.  AQE re-plans joins
# and coalesces small shuffle partitions at run time; skew-join splitting is
# on so that a hot supplier or register name does not land in one task.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# The JVM does not compile methods of more bytecode than this: a generated
# stage with such a method (the feeds' CASE expressions, the normaliser's
# rules) would run interpreted, so Spark is told to run its operators one by one,
# whose expressions it cuts into small methods.
HUGE_METHOD = "8000"


def with_small_methods(spark: SparkSession) -> SparkSession:
    """``spark``, set to leave whole-stage code with methods that the JVM would not compile."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", HUGE_METHOD)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgermatch") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder that the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session and used as it is.  A scratch folder
    is made only where it is unset and the master is a single process (tests);
    on any other master a missing setting is an error, as executors do not
    share a machine's temporary folder.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    active = sc._jsc.sc().getCheckpointDir()
    if named:
        if not active.isDefined():
            sc.setCheckpointDir(named)
        return named
    if active.isDefined():
        return active.get()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="ledgermatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for a written intermediate table, under the checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
