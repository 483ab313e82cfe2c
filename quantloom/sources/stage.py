"""Stage tables: results written once and read by several later steps.

A stage cuts the lineage and stops Spark from computing the same features again for each reader. It lives in the shared
folder the session names in ``spark.checkpoint.dir``, so it survives the loss of executors. Parquet keeps column pruning
and filter pushdown for the readers. Tables stay until ``drop_stages`` is told that their readers are done.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def stage_folder(spark: SparkSession) -> str:
    """The shared folder of the session; on a local master a fresh folder where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="quantloom-stage-")
    return _LOCAL_FOLDERS[app]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder and read it back."""
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def written_stages(spark: SparkSession) -> list[str]:
    """Folders of the stage tables that this application has written and not dropped."""
    return list(_WRITTEN.get(spark.sparkContext.applicationId, []))


def drop_stages(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete stage tables; only folders that ``stage`` itself has written in this application are touched."""
    held, sc = _WRITTEN.get(spark.sparkContext.applicationId, []), spark.sparkContext
    for path in set(paths) & set(held):
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
        held.remove(path)
