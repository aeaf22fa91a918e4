"""Session helpers: the shared checkpoint folder and lineage cuts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the session names none and all runs on one machine (``local`` masters, as in tests) is a temporary
    folder chosen and set; on a cluster that is an error, since executors could not read it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = os.path.join(tempfile.gettempdir(), f"codexmill-{uuid.uuid4().hex[:8]}")
        spark.conf.set("spark.checkpoint.dir", found)
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    Reliable, so the loss of an executor costs a re-read and nothing more.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def release(*frames: DataFrame) -> None:
    """Delete what ``cut`` has written for frames that nothing reads any more, as in loops that replace them."""
    for df in frames:
        plan = df._jdf.queryExecution().analyzed()
        file = plan.rdd().getCheckpointFile() if plan.getClass().getSimpleName() == "LogicalRDD" else None
        if file is not None and file.isDefined():
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started.

    The package's folder goes on the workers' path; on a cluster of machines the package itself is sent
    along, once for each application.
    """
    sc = spark.sparkContext
    if getattr(sc, "_codexmill_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [p for p in sc.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        sc.environment["PYTHONPATH"] = os.pathsep.join([root, *known])
    if not sc.master.startswith("local"):
        base = os.path.join(tempfile.mkdtemp(), "codexmill")
        sc.addPyFile(shutil.make_archive(base, "zip", root, "codexmill"))
    sc._codexmill_shipped = True
