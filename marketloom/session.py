"""Session defaults and the folder that driver and executors share."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and for bench.py; on a cluster the session is given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("marketloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only where that is unset and the master is local, as in tests: executors
    of a cluster don't see each other's folders."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="marketloom-")
        spark.sparkContext.setCheckpointDir(where)
    return where


def spread(df: DataFrame) -> DataFrame:
    """df dealt over as many tasks as a shuffle has: Spark reads a small file of many rows in few tasks, which is too few
    where each row is much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


#: Folders that written() has made: nothing else is ever deleted.
_MADE: set[str] = set()


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, and a lost executor loses nothing of it."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    path = f"{shared_folder(spark)}/marketloom/{name}"
    df.write.parquet(path)
    _MADE.add(name)
    return spark.read.parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables that written() made and nothing reads any more, views of them included."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if (name := folder.rpartition("/")[2]) in _MADE:
                where = spark._jvm.org.apache.hadoop.fs.Path(folder)
                where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
                _MADE.discard(name)


_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Sends this package to the workers, once for each application, unless they find it by path."""
    root = str(Path(__file__).resolve().parent.parent)
    found = os.getcwd() == root or root in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if not found and (app := spark.sparkContext.applicationId) not in _SHIPPED:
        target = tempfile.mkdtemp(prefix="marketloom-code-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{target}/marketloom", "zip", root, "marketloom"))
        _SHIPPED.add(app)
    return spark
