"""Session helpers: tables, shared scratch folder, shipping the package to executors."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()
_own_dirs: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where that is unset, a private folder of this machine on a local master; an error on a cluster,
    whose executors would not see each other's files there.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="trajkit-scratch-")
        spark.sparkContext.setCheckpointDir(_own_dirs[app])
    return "file://" + _own_dirs[app]


def run_dir(spark: SparkSession) -> str:
    """The folder below the shared one that holds all this application writes; ``clean`` removes it."""
    return f"{scratch_dir(spark)}/trajkit-{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> bool:
    """Remove what this application wrote to the shared folder, once no result that reads it is needed any more."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{run_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Most rows of a table of two numbers that is sent to all executors: some 32 MB.
SENT_ROWS = 1_000_000


def sent_if_small(rows: DataFrame, most: int = SENT_ROWS) -> DataFrame:
    """``rows`` (of a written table), marked to be sent to all executors where counting finds at most ``most`` of them."""
    return F.broadcast(rows) if rows.count() <= most else rows


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(spark: SparkSession) -> None:
    """Have the shuffle files of finished work deleted, which otherwise stay until the driver happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="trajkit-code-"), "trajkit_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)
