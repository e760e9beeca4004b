"""Session helpers shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as ``spark.checkpoint.dir`` names it.

    A local session without that setting gets a folder of its own; on a cluster
    that would be a folder of one machine, so there it is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="mortarline-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(own)
    return own


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder and read from there: what follows has no lineage before it.

    The table survives lost executors, later steps read only the columns they
    need, and it is deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/mortarline-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores before costly work on every row, if its scan is too small to fill them.

    A scan is never cut finer than ``spark.sql.files.openCostInBytes``; a table of
    fewer such pieces than there are cores is dealt out evenly.  Larger tables
    stay as they are read, without a shuffle.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    piece = int(spark.conf.get("spark.sql.files.openCostInBytes", "4194304").removesuffix("b"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * piece else df


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session with settings that small data needs."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        # the JVM compiles no method above 8,000 bytes; code of that size is better run operator by operator
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
