"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from footings.session import scratch_folder, shuffles_freed


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """`df` as a fresh Parquet table: later steps neither recompute it nor carry its plan along."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.options(**options).parquet(folder)
    shuffles_freed(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def removed(*tables: DataFrame) -> None:
    """Delete tables made by `written` that no later step reads."""
    for table in tables:
        context = table.sparkSession.sparkContext
        jvm = context._jvm
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
