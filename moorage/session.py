"""Session settings the operators rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Skew and size decisions are left to adaptive execution, so nothing is hinted by hand.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows with large geometries or pages go to Python in batches of bounded size.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def build_session(app: str = "moorage", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once."""
    context = spark.sparkContext
    if getattr(context, "_moorage_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="moorage-"), "moorage.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    bundle.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    context._moorage_shipped = True


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="moorage-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def workspace(spark: SparkSession, label: str) -> str:
    """A path for a new intermediate table, used by no other run."""
    return os.path.join(shared_root(spark), "moorage", f"{label}-{uuid.uuid4().hex}")


def settled(df: DataFrame, label: str) -> DataFrame:
    """The frame written to a table and read back.

    Used for results that are reused or joined to something large: they are computed once, survive
    lost executors, and their real size is known, so Spark broadcasts them if they are below its
    threshold and shuffles otherwise.
    """
    path = workspace(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
