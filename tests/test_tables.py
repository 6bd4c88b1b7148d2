"""Sinks, maintenance, repair, ingest and streams on temporary directories."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stallmetrics import schemas
from stallmetrics.operators import ingest, key_index, pricing, quality, repair
from stallmetrics.session import new_workdir, shared_folder
from stallmetrics.sinks import maintenance, tables
from stallmetrics.sources import paths, readers
from stallmetrics.streaming import changes, counts
from stallmetrics.streaming import ingest as stream
from tests.conftest import one, plan_of, rows
from tests.test_orders import D1, D2, D3, item
from tests.test_prices import products

DAY = schemas.PARTITION_COLUMN


@pytest.fixture
def table(spark):
    """Two copies on day 1, a clean day 2, a copy among rows without a date."""
    path = new_workdir(spark, "t") + "/table"
    df = spark.createDataFrame([
        item(1), item(1), item(2), item(3, D2), item(4, D2, order_amount=Decimal("2.00")), item(5, None), item(5, None),
    ], schemas.ORDER_ITEMS)
    tables.write_clustered(df, path)
    return path


def per_day(spark, path):
    return rows(spark.read.parquet(path).groupBy(DAY).count())


BEFORE = [(D1, 3), (D2, 2), (None, 2)]


def test_write_clustered_layout(spark, table):
    assert per_day(spark, table) == BEFORE
    assert paths.child_dirs(spark, table) == [f"{DAY}=2025-11-04", f"{DAY}=2025-11-05", f"{DAY}=__HIVE_DEFAULT_PARTITION__"]
    assert one(tables.table_profile(spark, table), "row_count", "partition_columns") == (7, DAY)


def test_day_filter_prunes_partitions(spark, table):
    plan = plan_of(spark.read.parquet(table).filter(F.col(DAY) == F.lit(D1)))
    assert "PartitionFilters: [isnotnull(order_created_date_tr" in plan


def test_backup_is_kept(spark, table):
    maintenance.backup_partition(spark, table, D1, table + "-b")
    maintenance.delete_partition(spark, table, D1)
    maintenance.backup_partition(spark, table, D1, table + "-b")  # nothing left to copy, backup stays
    assert per_day(spark, table + "-b") == [(D1, 3)] and per_day(spark, table) == BEFORE[1:]
    maintenance.restore_partition(spark, table + "-b", table, D1)
    assert per_day(spark, table) == BEFORE


def test_backup_table_refuses_to_overwrite(spark, table):
    maintenance.backup_table(spark, table, table + "-b")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        maintenance.backup_table(spark, table, table + "-b")


def test_replace_touches_only_its_days(spark, table):
    files = lambda: {r[0] for r in spark.read.parquet(table).filter(F.col(DAY) == F.lit(D2)).select(
        F.input_file_name()).distinct().collect()}
    before = files()
    maintenance.replace_partition(spark.createDataFrame([item(8)], schemas.ORDER_ITEMS), table)
    assert per_day(spark, table) == [(D1, 1), (D2, 2), (None, 2)] and files() == before


def test_rebuild_and_swap_keep_undated_rows(spark, table):
    clean = spark.createDataFrame([item(1), item(2)], schemas.ORDER_ITEMS)
    maintenance.rebuild_table(spark, table, D1, clean, table + "-new")
    maintenance.swap_table(spark, table + "-new", table, table + "-old")
    assert per_day(spark, table) == [(D1, 2), (D2, 2), (None, 2)] and per_day(spark, table + "-old") == BEFORE
    with pytest.raises(ValueError):
        maintenance.swap_table(spark, table + "-missing", table, table + "-x")
    maintenance.drop_temp(spark, table + "-old")
    assert not paths.exists(spark, table + "-old")


def test_repair_finds_and_cleans_all_days(spark, table):
    report = repair.repair_dates(spark, table, table + "-b")
    assert rows(report) == [(D1, 3, 2, 0), (None, 2, 1, 0)]
    assert per_day(spark, table) == [(D1, 2), (D2, 2), (None, 1)]
    summary = one(quality.duplicate_summary(spark.read.parquet(table)))
    assert summary[0] == summary[2] and summary[3] == 0


def test_repair_of_named_days(spark, table):
    assert rows(repair.repair_dates(spark, table, table + "-b", [D1])) == [(D1, 3, 2, 0)]
    assert per_day(spark, table) == [(D1, 2), (D2, 2), (None, 2)]


def test_rebuilt_tables_keep_their_clustering(spark, table):
    base = new_workdir(spark, "clustered")
    rows_of = spark.read.parquet(table)
    tables.write_clustered(rows_of, base + "/t", cluster="vendor_id")
    maintenance.rebuild_table(spark, base + "/t", D1, rows_of.filter(F.col(DAY) == F.lit(D1)).distinct(), base + "/n")
    profile = one(tables.table_profile(spark, base + "/n"), "row_count", "partition_columns", "cluster_columns")
    assert profile == (rows_of.count() - 1, DAY, "vendor_id")
    assert tables.cluster_columns(spark, table + "-none") == []


def test_repair_can_be_repeated(spark, table):
    first = rows(repair.repair_dates(spark, table, table + "-b"))
    after = per_day(spark, table)
    assert rows(repair.repair_dates(spark, table, table + "-b")) == first and per_day(spark, table) == after
    paths.delete(spark, f"{table}/{DAY}={D1}")  # lost in the middle of the replacement
    assert rows(repair.repair_dates(spark, table, table + "-b")) == first and per_day(spark, table) == after


def test_repair_replaces_an_unfinished_backup(spark, table):
    spark.read.parquet(table).limit(1).write.partitionBy(DAY).parquet(table + "-b")
    paths.delete(spark, table + "-b/_SUCCESS")
    assert rows(repair.repair_dates(spark, table, table + "-b")) == [(D1, 3, 2, 0), (None, 2, 1, 0)]


def test_repair_refuses_a_backup_that_lacks_rows(spark, table):
    repair.repair_dates(spark, table, table + "-b")
    later = spark.read.parquet(table).filter(F.col(DAY) == F.lit(D1)).limit(1).withColumn("city", F.lit("later"))
    later.write.mode("append").partitionBy(DAY).parquet(table)
    with pytest.raises(ValueError):
        repair.repair_dates(spark, table, table + "-b")


def test_repair_of_a_clean_table_changes_nothing(spark, table):
    repair.repair_dates(spark, table, table + "-b")
    after = per_day(spark, table)
    assert rows(repair.repair_dates(spark, table, table + "-b2")) == [] and per_day(spark, table) == after


def test_snapshots_are_versioned(spark):
    store = new_workdir(spark, "s") + "/snap"
    assert tables.load_snapshot(spark, store, schemas.PRODUCT_ROWS).count() == 0
    first = products(spark, [("a", "1", 1, "x")])
    assert [tables.save_snapshot(first, store), tables.save_snapshot(first.withColumn("price", F.lit(2.0)), store)] == [0, 1]
    assert one(tables.load_snapshot(spark, store, schemas.PRODUCT_ROWS), "price") == (2.0,)
    assert one(tables.load_snapshot(spark, store, schemas.PRODUCT_ROWS, before=1), "price") == (1.0,)


def test_create_tables_is_repeatable(spark):
    base = new_workdir(spark, "db")
    names = tables.create_tables(spark, "unit_mart", base)
    assert tables.create_tables(spark, "unit_mart", base) == names
    assert [c.name for c in spark.catalog.listColumns("unit_mart.price_history") if c.isPartition] == ["date"]
    maintenance.drop_temp(spark, "unit_mart.benchmarks")
    assert not spark.catalog.tableExists("unit_mart.benchmarks")


def test_bucketed_snapshots_join_without_a_shuffle(spark):
    base = new_workdir(spark, "b")
    one_row = products(spark, [("a", "1", 1, "x")])
    for name, rows_of in (("bk_old", one_row), ("bk_new", one_row.withColumn("price", F.lit(2.0)))):
        tables.write_bucketed(rows_of, name, f"{base}/{name}", pricing.KEY, 4)
    # Small tables would be broadcast; the hint asks for the join of large ones.
    changed = pricing.price_changes(spark.table("bk_old"), spark.table("bk_new").hint("merge"))
    assert "Exchange" not in plan_of(changed) and "SortMergeJoin" in plan_of(changed)
    assert one(changed, "old_price", "new_price") == (1.0, 2.0)
    assert one(tables.table_profile(spark, "bk_old"), "cluster_columns") == ("site_id,product_id",)


def test_exports(spark):
    base = new_workdir(spark, "x")
    tables.export_catalog(products(spark, [("a", "1", 1.5, "x")]), base + "/c")
    back = spark.read.option("header", True).csv(base + "/c")
    assert back.columns == tables.CATALOG_HEADER and one(back.drop("Timestamp")) == ("x", "1", "name 1", "1.5", "/1")
    stamped = spark.createDataFrame([(1, datetime(2025, 1, 1, 10))], "order_id long, t timestamp")
    tables.export_orders(stamped, base + "/o")
    assert one(spark.read.option("header", True).csv(base + "/o")) == ("1", "2025-01-01T10:00:00.000")


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_workdir(spark, "a").startswith(shared_folder(spark)) and new_workdir(spark, "a") != new_workdir(spark, "a")


# --- ingest ---------------------------------------------------------------------------

def batch(spark, *items):
    return spark.createDataFrame(list(items), schemas.ORDER_ITEMS)


def test_ingest_twice_is_ingest_once(spark):
    path = new_workdir(spark, "i") + "/orders"
    given = batch(spark, item(1), item(1), item(2, D2), item(3, None))
    assert ingest.ingest_batch(given, path) == {"status": "success", "received": 4, "inserted": 3, "skipped": 1}
    state = per_day(spark, path)
    assert ingest.ingest_batch(given, path) == {"status": "all_existing", "received": 4, "inserted": 0, "skipped": 4}
    assert per_day(spark, path) == state == [(D1, 1), (D2, 1), (None, 1)]
    assert ingest.ingest_batch(given.limit(0), path)["status"] == "empty"


def test_ingest_ignores_fields_outside_the_key(spark):
    path = new_workdir(spark, "i") + "/orders"
    ingest.ingest_batch(batch(spark, item(1, order_code=None)), path)
    changed = batch(spark, item(1, order_code="X", order_amount=Decimal("9.00"), order_delivery_date=D3,
                                order_creation_timestamp=datetime(2025, 1, 1)), item(1, city="other"))
    assert ingest.ingest_batch(changed, path)["inserted"] == 1


def test_replay_completes_a_half_written_batch(spark):
    path = new_workdir(spark, "i") + "/orders"
    given = batch(spark, item(1), item(2), item(3, D2))
    tables.append_rows(given.filter("order_id = 2"), path)  # what a lost run had left
    assert ingest.ingest_batch(given, path)["inserted"] == 2
    assert per_day(spark, path) == [(D1, 2), (D2, 1)]


def test_existing_rows_are_pruned_to_the_batch_days(spark, table, tmp_path):
    from stallmetrics.functions.filters import prune_days

    stored = spark.read.parquet(table)
    for name, given, want in (("few", [item(1), item(2, None)], [(D1, 3), (None, 2)]), ("wide", [item(1), item(2, D2)], [(D1, 3), (D2, 2)])):
        batch(spark, *given).write.parquet(f"{tmp_path}/{name}")
        kept = prune_days(stored, spark.read.parquet(f"{tmp_path}/{name}"))
        assert rows(kept.groupBy(DAY).count()) == want
        assert "dynamicpruning" in kept._jdf.queryExecution().executedPlan().toString()


def test_work_files_are_removed(spark):
    from stallmetrics.session import clean, work_folder
    from stallmetrics.sources.paths import child_dirs

    path = new_workdir(spark, "i") + "/orders"
    ingest.ingest_batch(batch(spark, item(1), item(2, D2)), path)
    assert not [d for d in child_dirs(spark, work_folder(spark)) if d.startswith("batch")]
    assert per_day(spark, path) == [(D1, 1), (D2, 1)]
    kept = work_folder(spark)
    clean(spark)
    assert child_dirs(spark, kept) == []


@pytest.fixture
def indexed(spark):
    path = new_workdir(spark, "x") + "/orders"
    name = "keys_" + path.split("/")[-2].rsplit("-", 1)[1]
    key_index.create_index(spark, path, name, 5)
    yield path, name
    spark.sql(f"DROP TABLE {name}")


def test_indexed_pulls_equal_plain_ones(spark, indexed):
    path, name = indexed
    given = batch(spark, item(1), item(1), item(2, D2), item(3, None))
    assert key_index.ingest_indexed(given, path, name) == {"status": "success", "received": 4, "inserted": 3, "skipped": 1}
    more = given.unionByName(batch(spark, item(4, D3)))
    assert key_index.ingest_indexed(more, path, name)["inserted"] == 1
    assert key_index.ingest_indexed(given.limit(0), path, name)["status"] == "empty"
    assert per_day(spark, path) == [(D1, 1), (D2, 1), (D3, 1), (None, 1)]
    assert spark.table(name).count() == 4


def test_an_index_that_lacks_a_day_is_filed_anew(spark, indexed):
    path, name = indexed
    key_index.ingest_indexed(batch(spark, item(1), item(2, D2)), path, name)
    tables.append_rows(batch(spark, item(5), item(6, None)), path)  # data of a run that was lost before its keys
    again = batch(spark, item(1), item(5), item(6, None), item(7))
    lacking = key_index.differing_days(readers.read_order_items(spark, path), spark.table(name))
    assert rows(lacking) == [(D1, 2, 1), (None, 1, 0)]
    assert key_index.ingest_indexed(again, path, name) == {"status": "success", "received": 4, "inserted": 1, "skipped": 3}
    assert key_index.refile(spark, path, name) == 0
    assert spark.table(name).count() == 5


def test_stored_keys_are_not_shuffled(spark, indexed):
    path, name = indexed
    key_index.ingest_indexed(batch(spark, item(1), item(2, D2)), path, name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(key_index.unseen_rows(batch(spark, item(1), item(9)), name))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SelectedBucketsCount: 5 out of 5" in plan and "dynamicpruning" in plan
    stored = plan[plan.rindex("Sort [row_key"):]
    assert "keys_" in stored and "Exchange hashpartitioning(row_key" not in stored


PAYLOAD = """[
 {"order_id": 1, "product_code_1": "p", "order_created_date": "2025-11-04T10:00:00Z", "additional_products": ["a", null],
  "order_delivery_date": "2025-11-05T00:00:00+03:00", "requested_delivery_date": "soon", "vendor_id": 7},
 {"order_id": 2, "order_created_date": "2025-11-05", "order_creation_timestamp": "2025-11-05T08:00:00"}]"""


def test_payload_to_table_rows(spark, tmp_path):
    (tmp_path / "p.json").write_text(PAYLOAD)
    got = ingest.conform(ingest.normalize_orders(readers.read_order_payload(spark, str(tmp_path / "p.json"))))
    assert got.schema.simpleString() == schemas.ORDER_ITEMS.simpleString()
    assert rows(got, "order_id", DAY, "order_delivery_date", "requested_delivery_date", "additional_products",
                "order_creation_timestamp") == [
        (1, D1, D2, None, "a, None", None), (2, D2, None, None, None, datetime(2025, 11, 5, 8))]


def test_payload_request():
    assert readers.payload_request("2025-11") == {"yearMonth": "2025-11"}
    assert readers.payload_request("2025-11-04") == {"day": "2025-11-04"}


def test_progress_mark_only_after_a_successful_incremental_day(spark, tmp_path):
    (tmp_path / "p.json").write_text(PAYLOAD)
    base = new_workdir(spark, "f")
    pull = lambda key, mode: ingest.run_fetch(
        spark, readers.read_order_payload(spark, str(tmp_path / "p.json")), base + "/o", base + "/m", key, mode, "2025-11-04 08:00:00")
    marks = lambda: tables.load_snapshot(spark, base + "/m", schemas.FETCH_WATERMARK)
    # The morning pull keeps the early rows of its day: the bare date counts as midnight.
    assert pull("2025-11-05", "morning") == {"status": "success", "received": 1, "inserted": 1, "skipped": 0}
    assert marks().count() == 0
    assert pull("2025-11", "incremental")["inserted"] == 1 and marks().count() == 0  # a month sets no mark
    assert pull("2025-11-04", "incremental")["status"] == "all_existing" and marks().count() == 0
    fresh = ingest.run_fetch(spark, batch(spark, item(77)), base + "/o", base + "/m", "2025-11-04", "incremental",
                             "2025-11-04 08:00:00")
    assert fresh["status"] == "success" and one(ingest.last_fetch(marks(), "2025-11-04")) == (datetime(2025, 11, 4, 8),)
    later = ingest.upsert_watermark(marks(), "2025-11-04", "2025-11-04 09:00:00")
    assert one(ingest.last_fetch(later, "2025-11-04")) == (datetime(2025, 11, 4, 9),) and later.count() == 1


# --- streams --------------------------------------------------------------------------

def test_stream_ingest_survives_redelivery(spark, tmp_path):
    landing, base = tmp_path / "landing", new_workdir(spark, "st")
    landing.mkdir()
    line = '{"order_id": %d, "order_created_date": "2025-11-0%dT10:00:00Z", "additional_products": ["a"]}\n'
    run = lambda: stream.stream_ingest(spark, str(landing), base + "/o", base + "/cp", 1).awaitTermination()
    (landing / "1.json").write_text(line % (1, 4) + line % (2, 5))
    run()
    (landing / "2.json").write_text(line % (1, 4) + line % (3, 5))
    (landing / "3.json").write_text(line % (3, 5) + line % (4, 1))  # late day
    run()
    assert per_day(spark, base + "/o") == [(date(2025, 11, 1), 1), (D1, 1), (D2, 2)]


def test_hourly_stream_closes_hours_behind_the_watermark(spark):
    base = new_workdir(spark, "h")
    at = lambda h, m: datetime(2024, 1, 1, h, m)
    for stamps in ([at(1, 10), at(1, 20), at(2, 5)], [at(1, 50), at(5, 0)], [at(1, 55)]):
        spark.createDataFrame([(s,) for s in stamps], "ts timestamp").coalesce(1).write.mode("append").parquet(base + "/in")
        source = spark.readStream.schema("ts timestamp").parquet(base + "/in")
        counts.write_counts(counts.hourly_counts(source), base + "/out", base + "/cp").awaitTermination()
    # The third file's row is later than the watermark (04:00) and is dropped.
    assert rows(spark.read.parquet(base + "/out")) == [(at(1, 0), 3), (at(2, 0), 1)]


def test_stream_of_runs_reports_changes_once(spark):
    base = new_workdir(spark, "c")
    runs = [[("a", "1", 1, "x"), ("b", "1", 5, "x")], [("a", "1", 2, "x"), ("b", "1", 5, "x")], [("a", "1", 2, "x"), ("b", "1", 6, "x")]]
    for n, run in enumerate(runs):
        rows_of_run = products(spark, run).withColumn("pos", F.lit(n))
        rows_of_run.coalesce(1).write.mode("append").parquet(base + "/in")
        source = spark.readStream.schema(rows_of_run.schema).parquet(base + "/in")
        changes.stream_changes(source, base + "/state", base + "/log", base + "/cp", ["pos"]).awaitTermination()
    log = changes.read_change_log(spark, base + "/log")
    assert rows(log, "run_id", "site_id", "old_price", "new_price") == [(1, "a", 1.0, 2.0), (2, "b", 5.0, 6.0)]


def test_repeated_run_gives_the_same_log(spark):
    base = new_workdir(spark, "c")
    first = products(spark, [("a", "1", 1, "x"), ("c", "1", 1, "x")]).withColumn("pos", F.lit(0))
    second = products(spark, [("a", "1", 2, "x")]).withColumn("pos", F.lit(0))
    for run_id, run in ((0, first), (1, second), (1, second)):
        changes.detect_run(run, run_id, base + "/state", base + "/log", ["pos"], keep_unseen=True)
    assert rows(changes.read_change_log(spark, base + "/log"), "run_id", "new_price") == [(1, 2.0)]
    assert tables.load_snapshot(spark, base + "/state", schemas.PRODUCT_ROWS).count() == 2


def test_backup_of_two_days_and_of_an_unfinished_one(spark, tmp_path):
    from pyspark.sql import functions as F

    from stallmetrics.sinks.maintenance import backup_partition, restore_partition, swap_table

    table, backup = str(tmp_path / "t"), str(tmp_path / "b")
    rows = spark.range(6).select("id", F.expr("date_add(DATE'2024-01-01', CAST(id % 3 AS INT))").alias("order_created_date_tr"))
    rows.write.partitionBy("order_created_date_tr").parquet(table)
    backup_partition(spark, table, "2024-01-01", backup)
    backup_partition(spark, table, "2024-01-02", backup)
    assert sorted(r["id"] for r in spark.read.parquet(backup).collect()) == [0, 1, 3, 4]
    (tmp_path / "b" / "order_created_date_tr=2024-01-02" / "_SUCCESS").unlink()
    backup_partition(spark, table, "2024-01-02", backup)
    assert sorted(r["id"] for r in spark.read.parquet(backup).collect()) == [0, 1, 3, 4]
    with pytest.raises(ValueError):
        restore_partition(spark, backup, table, "2024-01-03")
    restore_partition(spark, backup, table, "2024-01-02")
    assert spark.read.parquet(table).count() == 6
    rows.write.partitionBy("order_created_date_tr").parquet(str(tmp_path / "new"))
    with pytest.raises(ValueError):
        swap_table(spark, str(tmp_path / "new"), table, backup)
    assert spark.read.parquet(table).count() == 6


def test_writers_never_share_a_version(spark):
    store = new_workdir(spark, "s") + "/snap"
    df = products(spark, [("a", "1", 1, "x")])
    assert tables.save_snapshot(df, store) == 0
    assert tables._claimed_version(spark, store) == 1  # a writer that is still at work, or lost
    assert tables.save_snapshot(df.limit(0), store) == 2
    assert tables.save_snapshot(df, store, 7) == 7 and tables.save_snapshot(df, store, 7) == 7
    assert tables.save_snapshot(df, store) == 8
    assert tables.snapshot_versions(spark, store) == [0, 2, 7, 8]
    assert tables.expire_snapshots(spark, store, 2) == [0, 2] and tables.expire_snapshots(spark, store, 2) == []
    assert tables.load_snapshot(spark, store, schemas.PRODUCT_ROWS).count() == 1
    with pytest.raises(ValueError):
        tables.expire_snapshots(spark, store, 0)


def test_declared_columns_take_no_nulls(spark):
    base = new_workdir(spark, "mart")
    db = "mart_" + base.rsplit("-", 1)[1]
    tables.create_tables(spark, db, base)
    good = pricing.product_rows(products(spark, [("a", "1", 1, None)]))
    tables.load_table(good, f"{db}.products", schemas.PRODUCTS)
    assert spark.table(f"{db}.products").count() == 1
    with pytest.raises(Exception, match="site_name is null"):
        tables.load_table(good.withColumn("site_name", F.lit(None).cast("string")), f"{db}.products", schemas.PRODUCTS)
    assert spark.table(f"{db}.products").count() == 1


def test_sorting_modes(spark):
    df = products(spark, [("b", "1", 2, "y"), ("a", "2", 1, "z"), ("a", "1", 3, "x")])
    order = lambda mode: [(r.site_id, r.product_id) for r in pricing.sort_products(df, mode).collect()]
    assert order("price_asc") == [("a", "2"), ("b", "1"), ("a", "1")] and order("price_desc") == order("price_asc")[::-1]
    assert order("site") == [("a", "1"), ("a", "2"), ("b", "1")] and order("category") == [("a", "1"), ("b", "1"), ("a", "2")]
