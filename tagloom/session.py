"""Session helpers: a tuned builder for local runs, the shared scratch folder, and size checks."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Broadcast only what is counted to be below these bounds (rows); above them the plan falls back to a shuffle.
SMALL_TABLE_ROWS = 200_000


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tagloom") -> SparkSession:
    """Session for tests and benches. On a cluster, the cluster's own session settings win."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a private folder (tests); a cluster session must name a
    shared folder, because executors can be lost and lineage is cut by writing there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        configured = tempfile.mkdtemp(prefix="tagloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark application.

    Functions that run in workers are pickled by reference, so a worker must be able to import the package wherever it
    starts. The driver packs it and Spark hands the archive to every executor, also to those that join later."""
    sc = spark.sparkContext
    if getattr(sc, "_tagloom_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="tagloom-package-"), "tagloom.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._tagloom_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written tables (round trips, lineage cuts)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def materialize(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Used where one derived table (e.g. long-form term counts of the whole corpus) feeds several jobs of the same
    query: the upstream work (text scan, regex tokenising, shuffles) runs once instead of once per job, the lineage
    is cut (a lost executor re-reads the files instead of recomputing the text), and later scans get column pruning
    and filter pushdown on the written columns."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    (writer.option("compression", compression) if compression else writer).parquet(path)
    # the schema is known: without it Spark would start a job only to read it from the files
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> bool:
    """Counted size check used before any explicit broadcast (bounded: stops counting past the bound)."""
    return df.limit(max_rows + 1).count() <= max_rows


def maybe_broadcast(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> DataFrame:
    """Broadcast hint only behind a counted size check; otherwise leave the choice to AQE."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if is_small(df, max_rows) else df
