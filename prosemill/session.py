"""What a session needs: the package in the Python workers, and a folder that all of them share."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers, wherever they run: once for each SparkContext."""
    sc = spark.sparkContext
    if getattr(sc, "_prosemill_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="prosemill-zip-")) / "prosemill.zip"
    with zipfile.ZipFile(target, "w") as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._prosemill_shipped = True


def bounded(spark: SparkSession, rows: int = 1024, batch_mb: int = 4) -> None:
    """Ships the package and bounds Arrow batches by rows and bytes, so that a Python worker's memory is that of a few pages
    or texts, however many rows its task has."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_mb << 20))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names for shared files. One of our own only where none is set and all is one process."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    path = path or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        path = tempfile.mkdtemp(prefix="prosemill-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, if its scan has fewer splits than that would take: a file of one row group is one task, whatever
    follows. Tables of many files stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 2 * cores else df
