"""Published datasets: JSON in, tables out, and what is still to be done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_dataset(spark: SparkSession, path: str, schema: str, field: str,
                 multi_line: bool = True) -> DataFrame:
    """Rows of the array `field` of JSON documents, read with an explicit row schema."""
    document = f"{field} array<struct<{_struct_fields(schema)}>>"
    return (spark.read.schema(document).json(path, multiLine=multi_line)
            .select(F.inline(field)))


def _struct_fields(schema: str) -> str:
    return ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema))


def from_envelope(df: DataFrame, schema: str, columns: str = "columns", rows: str = "rows") -> DataFrame:
    """Decode {columns, rows} documents: each cell is found by its column's position."""
    def cell(field):
        position = F.array_position(F.col(columns), field.name).cast("int")
        value = F.when(position > 0, F.try_element_at(F.col("_row"), F.nullif(position, F.lit(0))))
        return value.try_cast(field.dataType).alias(field.name)

    exploded = df.select(columns, F.explode(rows).alias("_row"))
    return exploded.select(*[cell(f) for f in T.StructType.fromDDL(schema)])


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Write a dataset; partitioned writes are clustered first, so a value makes few files.

    The cluster step is a plain repartition hint that AQE may split, so one hot
    partition value is still written by many tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def index_summary(tables: dict[str, tuple[DataFrame, Column, Column, Column]]) -> DataFrame:
    """One row per dataset: rows, year range, headline year and distinct cited documents.

    Each entry is (table, year, is_headline, cited document); every table is
    aggregated on its own, so no summary row is ever joined to another.
    """
    parts = [
        df.agg(F.count("*").alias("n_rows"), F.min(year).alias("first_year"),
               F.max(year).alias("last_year"),
               F.max(F.when(headline, year)).alias("headline_year"),
               F.countDistinct(cited).alias("cited"))
        .select(F.lit(name).alias("dataset"), "*")
        for name, (df, year, headline, cited) in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def work_key(sha: Column, extractor: str, version: str, **options) -> Column:
    """Identity of a piece of work: content, extractor, version and options."""
    opts = "-".join(f"{k}={v}" for k, v in sorted(options.items()))
    return F.sha2(F.concat_ws("|", sha, F.lit(extractor), F.lit(version), F.lit(opts)), 256)


def pending(manifest: DataFrame, processed: DataFrame, key: str | list[str]) -> DataFrame:
    """Work not done yet for identical content, extractor, version and options."""
    return manifest.join(processed, key, "left_anti")


def dataset_digest(df: DataFrame, sha: str) -> DataFrame:
    """Order-independent fingerprint of a set of hashes, as one row.

    Hashes are counted first (copies collapse map-side); each hash with its count is
    hashed again, and the four 60-bit parts of that are summed.  Sums merge in any order
    and no list is built, however many hashes there are.
    """
    counted = df.groupBy(sha).agg(F.count("*").alias("_n"))
    entry = counted.select("_n", F.sha2(F.concat_ws(":", F.col(sha), F.col("_n").cast("string")), 256).alias("_e"))
    parts = [F.sum(F.conv(F.substring("_e", 1 + 15 * i, 15), 16, 10).cast("decimal(28,0)")).alias(f"_{i}") for i in range(4)]
    sums = entry.agg(*parts, F.sum("_n").alias("members"))
    digest = F.sha2(F.concat_ws(":", *[F.col(f"_{i}").cast("string") for i in range(4)]), 256)
    return sums.select(F.substring(digest, 1, 12).alias("digest"), "members")


def presence(expected: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """present / missing / extra for every hash on either side."""
    a = expected.select(key).distinct().withColumn("_want", F.lit(True))
    b = held.select(key).distinct().withColumn("_have", F.lit(True))
    return a.join(b, key, "full_outer").select(
        key, F.when(F.col("_want").isNull(), "extra").when(F.col("_have").isNull(), "missing")
        .otherwise("present").alias("presence"))
