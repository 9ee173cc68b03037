"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold on a laptop and on a cluster.  No join is hinted as a
# broadcast anywhere in the package: Spark broadcasts a side only after checking
# its size (estimate first, measured size under AQE) against
# spark.sql.autoBroadcastJoinThreshold, and falls back to a shuffled join.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "footings", master: str | None = None, **extra) -> SparkSession:
    """A session with the package settings; `master` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it in spark.checkpoint.dir.

    Where none is named, a local session (tests, a laptop) gets a scratch folder; on a
    cluster that would be a folder of one machine, so it is an error there.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    set_before = context._jsc.sc().getCheckpointDir()
    return set_before.get() if set_before.isDefined() else tempfile.mkdtemp()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, under the shared folder the cluster names."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def truncate_lineage(df: DataFrame) -> DataFrame:
    """Cut a long lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(os.path.join(shared_folder(df.sparkSession), "checkpoints"))
    return df.checkpoint()


PACKED = 32.0   # fixed value: bytes of rows that one byte of a stored table may stand for


def shuffles_freed(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are done.

    It does so once the driver collects the plans that wrote them; a driver with little to do
    may not for the whole of a job, and every step would add to the disk it takes.
    """
    spark._jvm.System.gc()


def stored(df: DataFrame) -> DataFrame:
    """Cut a long lineage with a compressed table in the shared folder.

    A checkpoint keeps rows as they lie in memory; printed lines in columns take a small part of that.
    Spark takes a file's size for the size of its rows when it plans a broadcast, so it is told how
    far they are apart; what it measures later still decides.
    """
    settings, name = df.sparkSession.conf, "spark.sql.sources.fileCompressionFactor"
    if float(settings.get(name)) < PACKED:
        settings.set(name, str(PACKED))
    folder = scratch_folder(df.sparkSession, "step")
    df.write.option("compression", "zstd").parquet(folder)
    shuffles_freed(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def spread_pages(pages: DataFrame, *keys: str) -> DataFrame:
    """Pages by key over all shuffle partitions: they are small while whole, so Spark would join
    many of them into one task, but their lines are not."""
    return pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
