"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def get_session(app: str = "cellweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC time and Arrow exchange switched on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: `spark.checkpoint.dir`.

    Only a session whose executors run in the driver may do without it and gets a new folder of this machine; on a
    cluster each executor would write to its own disk, so that a missing setting is an error.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


@dataclass(frozen=True)
class Stage:
    """A table written to the shared folder; reading it needs nothing that an executor holds."""

    df: DataFrame
    path: str

    def drop(self) -> None:
        """Remove the files, once nothing that is still to run reads them."""
        _delete(self.df.sparkSession, self.path)
        _WRITTEN.get(self.df.sparkSession.sparkContext.applicationId, set()).discard(self.path)


#: Folders of the tables that are written and not yet dropped, by application.
_WRITTEN: dict[str, set[str]] = {}


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def materialize(df: DataFrame, name: str = "stage", by: str | None = None) -> Stage:
    """Write `df` as parquet to the shared folder and read it back: the lineage ends there.

    `by` names a column whose values get folders of their own, so that a filter on it reads no other rows.
    The files stay until `Stage.drop` or `release`, at the longest until the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    files, at = _files(spark, path)
    files.deleteOnExit(at)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, set()).add(path)
    schema = T.StructType([*(f for f in df.schema if f.name != by), *(f for f in df.schema if f.name == by)])
    return Stage(spark.read.schema(schema).parquet(path), path)


def release(spark: SparkSession) -> int:
    """Drop every written table of this application; returns their number.

    For use after the last action on the results of the operators: what they return reads these tables.
    """
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, set())
    for path in paths:
        _delete(spark, path)
    return len(paths)
