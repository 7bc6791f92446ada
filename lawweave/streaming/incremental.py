"""Incremental ingestion: a stream of row versions kept as a table with the last version of each key.

Keys are dealt over buckets.  Each micro-batch is reduced to one row per key and merged with the buckets it touches
only; these are written as new versions beside the old ones, and the table's list of versions changes after that, so a
failed or repeated batch never leaves a half-written table.  Versions that neither of the last two lists names are
removed.  Which row wins is decided by its order columns, never by its arrival, so the result equals the batch result.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from lawweave.operators.merge import last_per_key

#: Buckets the keys are dealt over, unless a table is made with another number.
BUCKETS = 64


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder; a temporary one only where no such folder is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"


class KeyedTable:
    """The current version of the table: for each bucket the number of the batch that last wrote it."""

    def __init__(self, spark: SparkSession, folder: str, keys: Sequence[str], order: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.folder, self.keys, self.order, self.buckets = spark, folder, list(keys), list(order), buckets
        self.lists: dict[int, dict[int, int]] = {-1: {}}  # after each batch: bucket -> version
        self.schema: StructType | None = None

    def merge(self, batch: DataFrame, number: int) -> None:
        """``foreachBatch`` target; a batch that comes again overwrites its own versions with the same rows."""
        before = self.lists[max(v for v in self.lists if v < number)]
        self.schema = batch.schema
        new = last_per_key(batch, self.keys, self.order).withColumn("_bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))
        new = new.persist()
        touched = sorted(r[0] for r in new.select("_bucket").distinct().collect())  # at most ``buckets`` rows
        old = self._read({k: before[k] for k in touched if k in before})
        rows = new if old is None else last_per_key(old.unionByName(new), self.keys, self.order)
        rows.repartition(max(1, len(touched)), "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.folder}/v{number}")
        new.unpersist()
        self.lists = {v: x for v, x in self.lists.items() if v < number} | {number: before | dict.fromkeys(touched, number)}
        self._forget()

    def _forget(self) -> None:
        """Keep what the last two lists name: the last batch may come again."""
        kept = sorted(self.lists)[-2:]
        self.lists = {v: self.lists[v] for v in kept}
        alive = {(k, v) for x in self.lists.values() for k, v in x.items()}
        fs, path = self._files()
        for version in fs.listStatus(path) if fs.exists(path) else ():
            number = int(version.getPath().getName()[1:])
            for part in fs.listStatus(version.getPath()):
                name = part.getPath().getName()
                if name.startswith("_bucket=") and (int(name[8:]), number) not in alive:
                    fs.delete(part.getPath(), True)

    def _files(self) -> tuple:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _read(self, versions: dict[int, int]) -> DataFrame | None:
        """The rows of some buckets, each in its version, with their bucket."""
        if not versions:
            return None
        by = defaultdict(list)
        for k, v in versions.items():
            by[v].append(k)
        whole = StructType([*self.schema.fields, StructField("_bucket", IntegerType())])
        parts = [self.spark.read.schema(whole).parquet(f"{self.folder}/v{v}").where(F.col("_bucket").isin(*ks)) for v, ks in sorted(by.items())]
        return reduce(DataFrame.unionByName, parts)

    def current(self) -> DataFrame | None:
        rows = self._read(self.lists[max(self.lists)])
        return None if rows is None else rows.drop("_bucket")


def _folder(spark: SparkSession, path: str) -> tuple[str, str]:
    """The folder a stream listens to and the files in it that count: a path may name a folder or a single file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return path, "*.parquet"
    return p.getParent().toString(), p.getName()


def ingest(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], files_per_batch: int = 4) -> DataFrame:
    """Stream all Parquet files of a path through the keyed table and return its last version."""
    schema = spark.read.parquet(path).schema
    folder = shared_folder(spark)
    table = KeyedTable(spark, f"{folder}/table", keys, order)
    folder_of, only = _folder(spark, path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", only).parquet(folder_of)
    query = source.writeStream.foreachBatch(table.merge).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    rows = table.current()
    return spark.createDataFrame([], schema) if rows is None else rows
