"""Source files: inventory by content hash, and which version of a file counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _empty_files(spark: SparkSession, root: str) -> list[str]:
    """Names of zero-length files, which Spark's file scan passes over without a row.

    The listing is metadata, walked like the one Spark's reader makes; only the names of
    empty files, each of them an error, are kept.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    listing = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    names = []
    while listing.hasNext():
        status = listing.next()
        name = status.getPath().getName()
        if status.getLen() == 0 and not name.startswith((".", "_")):
            names.append(status.getPath().toString())
    return names


def inventory(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(files, violations) under a folder: path, bytes, sha256, extension; empty files rejected."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    good, _ = content_inventory(files, "path", F.col("content"))
    bad = spark.createDataFrame([(n, "empty file") for n in _empty_files(spark, root)], "path string, problem string")
    return good, bad


def content_inventory(df: DataFrame, name: str, content: Column) -> tuple[DataFrame, DataFrame]:
    """Fingerprint each row's content; rows without content are violations, never sources."""
    size = F.coalesce(F.octet_length(content), F.lit(0))
    marked = df.select(
        name, size.alias("bytes"), F.sha2(content.cast("binary"), 256).alias("sha256"),
        F.lower(F.regexp_extract(F.col(name).cast("string"), r"\.([A-Za-z0-9]+)$", 1)).alias("extension"))
    empty = F.col("bytes") == 0
    return (marked.filter(~empty),
            marked.filter(empty).select(name, F.lit("empty file").alias("problem")))


def newest_version(files: DataFrame, stem: str, name: str, version: str = r"v(\d+)\.(\d+)",
                   last_on_tie: bool = True) -> DataFrame:
    """The highest-versioned file of each stem; equal versions resolve by name.

    Rank 1 is selected with a plain rank filter, which Spark also applies before
    the shuffle, so a stem with very many files ships one row per task.
    """
    def part(group):
        return F.coalesce(F.regexp_extract(name, version, group).try_cast("int"), F.lit(0))

    tie = F.col(name).desc() if last_on_tie else F.col(name).asc()
    w = Window.partitionBy(stem).orderBy(part(1).desc(), part(2).desc(), tie)
    return files.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
