"""Tables written to the folder that all executors share, so that a lost executor costs a step and not a lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_own_dir: list[str] = []
#: tables this process wrote, by session
_written: dict[int, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset a temporary folder, which only a local master can share."""
    if conf := spark.conf.get("spark.checkpoint.dir", None):
        return conf.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder all executors of {master} share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="adjudica-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return f"file://{_own_dir[0]}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """df written once and read again: every reader sees the same rows in the same partitions. by: a folder for each value
    of a column, so that a reader of one value reads no other."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    out = df.write.option("compression", "zstd")
    (out.partitionBy(by) if by else out).parquet(path)
    _written.setdefault(id(df.sparkSession._jsparkSession), []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, **figures: Column) -> tuple[DataFrame, dict]:
    """written(), and figures of its rows (aggregates by name) that are taken in the pass that writes."""
    seen = Observation()
    back = written(df.observe(seen, *[c.alias(k) for k, c in figures.items()]), name)
    return back, seen.get


def clear(spark: SparkSession) -> int:
    """Call once results are written: removes the tables written for this session; how many went."""
    gone = _written.pop(id(spark._jsparkSession), [])
    for path in gone:
        delete(spark, path)
    return len(gone)
