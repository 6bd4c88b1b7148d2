"""Sinks: declared tables, appends, clustered rewrites, versioned snapshots, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from stallmetrics import schemas
from stallmetrics.schemas import PARTITION_COLUMN
from stallmetrics.session import settings
from stallmetrics.sources import paths

#: Compression of tables that are written whole.
WHOLE = {"compression": "zstd"}


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> list[str]:
    """Declare the mart's tables with nullability and day partitioning, if absent."""
    plan = {
        "products": (schemas.PRODUCTS, None),
        "price_history": (schemas.PRICE_HISTORY, "date"),
        "benchmarks": (schemas.BENCHMARKS, "date"),
        "fetch_watermark": (schemas.FETCH_WATERMARK, None),
        "order_items": (schemas.ORDER_ITEMS, PARTITION_COLUMN),
    }
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{at}")
    for name, (schema, partition) in plan.items():
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
        )
        by = f" PARTITIONED BY (`{partition}`)" if partition else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{by}")
    return [f"{database}.{name}" for name in plan]


def load_table(rows: DataFrame, table: str, schema: StructType, partition: str | None = None) -> None:
    """Append rows to a declared table, in its column order and types. A null in a NOT NULL column
    fails the load, which the file format itself would not."""

    def column(f: StructField):
        value = F.col(f.name).cast(f.dataType)
        missing = F.raise_error(F.lit(f"{table}.{f.name} is null")).cast(f.dataType)
        return (value if f.nullable else F.coalesce(value, missing)).alias(f.name)

    spark = rows.sparkSession
    checked = rows.select(*[column(f) for f in schema.fields]).select(*spark.table(table).columns)
    (balanced(checked, partition) if partition else checked).write.insertInto(table)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Gather rows of the same partition value for writing. AQE splits a value that holds
    much of the data over several tasks and merges small ones, so no day is one task."""
    return df.hint("rebalance", *columns)


#: Folder with a table's clustering note; readers of the table skip names that begin so.
CLUSTERING = "_clustering"


def append_rows(df: DataFrame, path: str, partition: str | None = PARTITION_COLUMN) -> None:
    if partition is None:
        df.write.mode("append").parquet(path)
    else:
        balanced(df, partition).write.mode("append").partitionBy(partition).parquet(path)


def write_clustered(df: DataFrame, path: str, partition: str = PARTITION_COLUMN, cluster: str = "order_id",
                    mode: str = "errorifexists") -> None:
    """Partitioned by day and sorted by the cluster column, so that Parquet min/max
    statistics skip row groups on that column. The column is noted beside the data."""
    ordered = balanced(df, partition).sortWithinPartitions(partition, cluster)
    ordered.write.mode(mode).options(**WHOLE).partitionBy(partition).parquet(path)
    note_clustering(df.sparkSession, path, cluster)


def note_clustering(spark: SparkSession, path: str, cluster: str) -> None:
    """Note beside a table's data what it is clustered by."""
    spark.createDataFrame([(cluster,)], "cluster string").write.mode("overwrite").json(f"{path}/{CLUSTERING}")


#: Bytes of files that a task copies; it holds and sorts their rows.
COPIED = {"spark.sql.files.maxPartitionBytes": "16m", "spark.sql.files.openCostInBytes": "1m"}
#: Files of a partition value, on average, up to which a table counts as gathered, besides those that its size alone explains.
FEW_FILES, FILE_BYTES = 4, 8 << 20


def gathered(spark: SparkSession, path: str) -> bool:
    """Whether the files of a partitioned table are few enough to be copied one by one. One that
    appends have left in small pieces is better dealt anew."""
    files, size = paths.content(spark, path)
    return files <= FEW_FILES * max(1, len(paths.child_dirs(spark, path))) + size // FILE_BYTES


def write_copied(rows: DataFrame, path: str, partition: str, clusters: list[str], mode: str = "errorifexists") -> None:
    """Rows of a partitioned table's files, written as they lie: nothing is shuffled. A task reads files of few
    partition values, so it writes few; sorting is in memory."""
    with settings(rows.sparkSession, COPIED):
        rows.sortWithinPartitions(partition, *clusters).write.mode(mode).options(**WHOLE).partitionBy(partition).parquet(path)


def cluster_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns that a table in a folder is clustered by (none without a note)."""
    note = f"{path}/{CLUSTERING}"
    return [r[0] for r in spark.read.schema("cluster string").json(note).collect()] if paths.exists(spark, note) else []


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns that a table in a folder is partitioned by."""
    return sorted({d.split("=", 1)[0] for d in paths.child_dirs(spark, path) if "=" in d})


def write_bucketed(df: DataFrame, table: str, path: str, columns: list[str], buckets: int) -> None:
    """Catalog table bucketed and sorted by its key, so that joins and aggregates on the key
    need no shuffle. The repartition gives one file per bucket; keys should be unique or
    near it, since a bucket holds all rows of its keys."""
    writer = df.repartition(buckets, *columns).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *columns).sortBy(*columns).saveAsTable(table)


def insert_from(src: DataFrame, path: str, partition: str = PARTITION_COLUMN) -> None:
    """INSERT INTO ... SELECT."""
    append_rows(src, path, partition)


#: Folder of a snapshot store with one empty file for each version that a writer has taken.
CLAIMS = "_claims"
#: How versions are written: all rows anew each time, so as small as files go.
SNAPSHOTS = {"compression": "zstd"}


def snapshot_versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a snapshot store, oldest first."""
    found = [d for d in paths.child_dirs(spark, path) if d.startswith("snapshot_id=")]
    return sorted(int(d.split("=", 1)[1]) for d in found if paths.exists(spark, f"{path}/{d}/_SUCCESS"))


def _claimed_version(spark: SparkSession, path: str) -> int:
    """The next version, which no other writer gets. That of a writer that failed stays out of use."""
    known = snapshot_versions(spark, path)
    taken = [int(n) for n in paths.child_files(spark, f"{path}/{CLAIMS}") if n.isdigit()]
    version = max([-1, *known, *taken]) + 1
    while not paths.claim(spark, f"{path}/{CLAIMS}/{version}"):
        version += 1
    return version


def save_snapshot(df: DataFrame, path: str, version: int | None = None) -> int:
    """Publish the newest state as a new version; readers of older ones are not disturbed.

    Writers that name no version each get one of their own. A named version is written anew,
    which makes a replayed micro-batch harmless.
    """
    if version is None:
        version = _claimed_version(df.sparkSession, path)
        df.write.mode("errorifexists").options(**SNAPSHOTS).parquet(f"{path}/snapshot_id={version}")
    else:
        df.write.mode("overwrite").options(**SNAPSHOTS).parquet(f"{path}/snapshot_id={version}")
    return version


def expire_snapshots(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all complete versions but the newest ``keep``; returns the deleted ones."""
    if keep < 1:
        raise ValueError("at least one version is kept")
    gone = snapshot_versions(spark, path)[:-keep]
    for version in gone:
        paths.delete(spark, f"{path}/snapshot_id={version}")
    return gone


def load_snapshot(spark: SparkSession, path: str, schema, before: int | None = None) -> DataFrame:
    """Newest complete version (older than ``before`` if given), empty on the first run."""
    known = [v for v in snapshot_versions(spark, path) if before is None or v < before]
    if not known:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/snapshot_id={known[-1]}")


def append_price_history(snapshot: DataFrame, path: str, run_date) -> None:
    """Observations of one run, filed under the load date."""
    rows = snapshot.select(
        "product_id", "site_id", F.col("price").cast("double").alias("price"), "timestamp",
        F.lit(run_date).cast("date").alias("date"),
    )
    append_rows(rows, path, "date")


def append_benchmarks(by_site: DataFrame, path: str, run_ts: Column) -> None:
    """Per-site statistics of one run, filed under its day."""
    rows = by_site.select(
        F.to_date(run_ts).alias("date"), run_ts.alias("timestamp"), "site_id", "site_name",
        "product_count", "avg_price", "min_price", "max_price",
    )
    append_rows(rows, path, "date")


# Header of the catalog export.
CATALOG_HEADER = ["Timestamp", "Category", "Product ID", "Product name", "Price", "Product Link"]
# End of fixed values.


def export_catalog(products: DataFrame, path: str, loaded_at: Column | None = None) -> None:
    """Whole catalog with header and load time; replaces the last export."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    columns = [stamp, F.col("category"), F.col("product_id"), F.col("product_name"), F.col("price"), F.col("url")]
    out = products.select(*[c.alias(name) for c, name in zip(columns, CATALOG_HEADER)])
    out.write.mode("overwrite").option("header", True).csv(path)


def append_change_log(changes: DataFrame, path: str, logged_at: Column | None = None, fmt: str = "parquet") -> None:
    """One log row per price change."""
    stamp = F.current_timestamp() if logged_at is None else logged_at
    rows = changes.select(stamp.alias("logged_at"), "product_id", "product_name", "old_price", "new_price",
                          "price_diff", "url")
    rows.write.mode("append").format(fmt).save(path)


def export_orders(orders: DataFrame, path: str) -> None:
    """Order list as CSV with a header; timestamps lose their zone."""
    plain = orders.select(*[
        F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)
        for name, kind in orders.dtypes
    ])
    plain.write.mode("overwrite").option("header", True).csv(path)


def table_profile(spark: SparkSession, name_or_path: str) -> DataFrame:
    """One row: number of rows, column names, partition and clustering columns."""
    is_path = "/" in name_or_path
    df = spark.read.parquet(name_or_path) if is_path else spark.table(name_or_path)
    if is_path:
        partition, cluster = partition_columns(spark, name_or_path), cluster_columns(spark, name_or_path)
    else:
        info = spark.catalog.listColumns(name_or_path)
        partition = [c.name for c in info if c.isPartition]
        cluster = [c.name for c in info if c.isBucket]
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(name_or_path).alias("table"), "row_count", F.lit(",".join(df.columns)).alias("columns"),
        F.lit(",".join(partition)).alias("partition_columns"), F.lit(",".join(cluster)).alias("cluster_columns"),
    )
