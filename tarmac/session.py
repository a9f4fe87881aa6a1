"""Session setup, the shared scratch folder, and lineage cuts."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "tarmac", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the reports rely on; `conf` keys use __ for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are read, windowed and printed in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers, wherever they run, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in spark.checkpoint.dir.

    Only a local-mode session may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tarmac-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/tarmac/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to a table in the shared folder and read it back from there.

    For large frames whose rows depend on how their scan was split: a second scan may be split
    differently when the cluster has grown or shrunk in between.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def settle(df: DataFrame) -> DataFrame:
    """Compute `df` once into the reliable checkpoint folder.

    For small results that several later steps read: it saves a second pass over the events,
    and lost executors cost a re-read, not a recomputation.
    """
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def fits_broadcast(settled: DataFrame, max_bytes: int = 8 << 20) -> bool:
    """Whether a settled frame is small enough to ship to every executor.

    Bytes are counted as fixed-width fields of the row format; a text counts with its length.
    """
    wide = 8 * (len(settled.columns) + 1)
    texts = [name for name, kind in settled.dtypes if kind == "string"]
    more = [F.coalesce(F.octet_length(name), F.lit(0)) for name in texts]
    size = F.sum(functools.reduce(lambda a, b: a + b, more, F.lit(wide).cast("long")))
    return (settled.agg(size).first()[0] or 0) <= max_bytes
