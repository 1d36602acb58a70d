"""Tables written to the folder all executors share, to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.  Where the session names none a
    temporary one is set on a single machine (master local); on a cluster that
    is an error, as no other executor would find what is written there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        have = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = have.get() if have.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="quern-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str = "t", by: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later
    stages neither repeat its work nor depend on an executor that may be lost.
    With ``by`` there is a folder of each value of that text column."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quern-{name}-{uuid.uuid4().hex}"
    to = df.write.option("compression", "zstd")
    (to.partitionBy(by) if by else to).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(df: DataFrame) -> None:
    """Removes the table of ``df``, as ``materialize`` gave it; nothing that is
    still to be run may read it."""
    spark = df.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.written_to)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where it has fewer partitions than there are, as a
    table of a single small file; a table of more is left as it lies.  Only for
    passes whose rows don't depend on each other."""
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the workers this package, once for each application, so that they
    need no path of their own to it."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="quern-"), "quern.zip")  # served by the driver
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
