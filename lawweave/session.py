"""Session building, table loading and lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Settings a session of our own gets; a session that is handed in keeps its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; ``master`` is only set where given."""
    b = SparkSession.builder.appName("lawweave").config(map={**DEFAULTS, **conf})
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str | Column) -> DataFrame:
    """One of the Parquet tables; only the named columns, so that the scan is pruned."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage.

    The folder is the session's ``spark.checkpoint.dir``.  Only where that is unset (as in
    tests on one machine) a temporary folder is used.  The copy outlives lost executors.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp")))
    return df.checkpoint(eager=True)


def small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast of ``df`` only if it has at most ``max_rows`` rows; else leave the join to Spark.

    ``df`` should be cheap to evaluate or materialised: the check reads at most ``max_rows + 1`` of its rows.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
