"""Session helpers: local sessions for tests and benchmarks, lineage cuts."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings every operator is tuned for; a cluster sets the same ones in its defaults.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(app: str = "gridloom", cores: int | str = "*", **extra: str) -> SparkSession:
    """A ``local[cores]`` session; ``extra`` takes settings with ``__`` for ``.``."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors, once per application.

    Python workers import it for the file decoders. Not needed where it is
    installed on the cluster or was given with ``--py-files``.
    """
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="gridloom-package-")
    # Spark copies the archive from the driver to every executor.
    archive = shutil.make_archive(f"{folder}/gridloom", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would lose the data with its executor.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-checkpoint-"))
    return sc.getCheckpointDir()


def settle(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table to the shared checkpoint folder and go on from there.

    Cuts the lineage between the rounds of an iteration and before a chain of
    scans that would otherwise compute its input several times. The table is
    columnar, so later steps read only the columns they use, and it outlives
    the executors that wrote it. ``partition_by`` makes a folder per value, so
    that later filters on those columns read no other rows.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/gridloom/settled-{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_counted(df: DataFrame, partition_by: tuple[str, ...] = (), **counts) -> tuple[DataFrame, dict[str, int]]:
    """``settle``, and aggregates worked out over the rows while they are written (``n``: their number)."""
    seen = Observation()
    totals = {"n": F.count(F.lit(1)), **counts}
    written = settle(df.observe(seen, *[c.alias(name) for name, c in totals.items()]), partition_by)
    return written, {name: value or 0 for name, value in seen.get.items()}
