"""Plans and files that decide how much is shuffled, written and held."""

import re

from pyspark.sql import functions as F

from stallmetrics.plans import views
from tests.conftest import plan_of

SMALLEST = "/root/testdata/sf0.001"


def below(plan: str, operator: str) -> str:
    """The part of a plan text under the first line with an operator."""
    lines = plan.split("\n")
    at = next(k for k, line in enumerate(lines) if operator in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    end = next((k for k in range(at + 1, len(lines)) if depth(lines[k]) <= depth(lines[at])), len(lines))
    return "\n".join(lines[at + 1:end])


def test_customers_join_orders_before_items(spark):
    """Items are shuffled by part and by order only, not by customer too."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(views.order_items(spark, SMALLEST))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "c_custkey" in below(plan, "SortMergeJoin [o_custkey") and "l_orderkey" not in below(plan, "SortMergeJoin [o_custkey")
    assert "p_partkey" in below(plan, "SortMergeJoin [l_partkey") and "o_orderkey" not in below(plan, "SortMergeJoin [l_partkey")


def test_payload_files_are_compressed_and_land_twice(spark):
    from stallmetrics.plans import streams
    from stallmetrics.session import new_workdir
    from stallmetrics.sources import paths

    landing = new_workdir(spark, "landing")
    rows = spark.range(5).selectExpr("id AS order_id", "'x' AS city")
    for _ in range(2):
        streams.deliver(spark, rows, landing)
    files = [f for f in paths.child_files(spark, landing) if f.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    landed = spark.read.schema("order_id long, city string").json(landing)
    assert sorted(r.order_id for r in landed.collect()) == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4] and landed.filter("city = 'x'").count() == 10


def test_changing_payload_builds_no_schema_text_and_its_map_once(spark, tmp_path):
    """A schema text per object, and a map of the read fields per field, made up much of the reading time."""
    from stallmetrics import schemas
    from stallmetrics.sources import variants

    (tmp_path / "a.json").write_text('{"order_id": 1, "x": {"y": 2}}\n [{"order_id": "z"}, 3]\n[]\n')
    found = variants.read_changing_payload(spark, str(tmp_path), schemas.ORDER_PAYLOAD)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "schema_of_variant" not in plan.lower() and "schemaofvariant" not in plan.lower()
    assert plan.index("map_from_arrays") < plan.index("map_filter") or "array(map_from_arrays" in plan
    got = [(r.order_id, sorted((r["rest"] or {}).items())) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(1, [("x", '{"y":2}')]), (None, [("order_id", '"z"')]), (None, [("", "3")])], key=str)


def test_pull_and_repair_deal_whole_rows_once(spark, monkeypatch):
    """Rows are dealt by day and order, in parts that a large order or rows without one fill as well; copies share a part."""
    from pyspark.sql import functions as F

    from stallmetrics.functions.keys import row_digest
    from stallmetrics.operators import dedupe

    monkeypatch.setattr(dedupe, "PART_ROWS", 10)
    rows = spark.range(400).selectExpr("DATE'2025-01-01' AS day", "CASE WHEN id < 100 THEN 7 WHEN id < 200 THEN NULL ELSE id DIV 4 END AS o",
                                       "id DIV 2 AS v").unionByName(spark.sql("SELECT CAST(NULL AS DATE) AS day, 1L AS o, 1L AS v"))
    placed = dedupe.dealt(rows, "day", F.xxhash64("o"), row_digest(rows))
    parts = lambda where: placed.filter(where).select(dedupe.PART).distinct().count()
    assert parts("o = 7") > 3 and parts("o IS NULL") > 3
    nulls = dedupe.dealt(rows, "day", F.col("o"), row_digest(rows)).filter("o IS NULL")
    assert nulls.select(dedupe.PART).distinct().count() > 3
    assert placed.groupBy("day", "o").agg(F.count_distinct(dedupe.PART).alias("n")).filter("o <> 7 AND n > 1").isEmpty()  # small orders stay together
    clean = dedupe.dedupe_exact(placed)
    assert clean.drop(dedupe.PART).exceptAll(rows.distinct()).isEmpty() and clean.count() == 201
    dealt_by = re.findall(r"Exchange hashpartitioning\(day#\d+, (\w+)", plan_of(clean))
    assert [c for c in dealt_by if c in ("o", "v", dedupe.PART)] == [dedupe.PART]


def test_new_rows_of_a_pull_need_one_exchange_of_rows(spark):
    from stallmetrics.operators import ingest
    from stallmetrics.plans.views import order_items

    rows = ingest.conform(order_items(spark, SMALLEST))
    plan = plan_of(ingest.new_rows(rows, rows.limit(0)))
    assert "Exchange hashpartitioning(order_created_date_tr" in plan and "__part" in plan
    assert "Exchange hashpartitioning(row_key_1" not in plan


def test_scattered_ids_are_rolled_up_without_sorting_large_bitmaps(spark):
    from stallmetrics.operators import rollup

    ids = [0, 1, 63, 64, -1, -64, -65, 2**62, -2**63, 2**63 - 1, 64, 0]
    fact = spark.createDataFrame([(i, 1, "x") for i in ids], "order_id long, vendor_id long, city string").selectExpr(
        "*", "DATE'2025-01-01' AS order_created_date_tr", "1.0 AS order_amount", "'p' AS payment_method")
    bitmaps = rollup._parts(fact, ["payment_method"], "month")[rollup.BITMAPS]
    assert dict(bitmaps.dtypes)["bitmap"] == "bigint"
    found = rollup._distinct_ids(bitmaps)
    assert "SortAggregate" not in plan_of(found)
    assert sorted((r["name"], r["n"]) for r in found.collect()) == [("order_id", 10), ("vendor_id", 1)]


def test_pages_are_spread_after_they_have_their_site(spark):
    from stallmetrics import schemas
    from stallmetrics.operators import pages

    html = spark.createDataFrame([(1, "https://a.example/x", '<div class="c"><h2>N</h2><i class="p">5 TL</i></div>')], schemas.PAGES)
    site = spark.createDataFrame([("a", "A", "https://a.example", (".c", "h2", ".p", "a"))],
                                 "id string, name string, url string, selectors struct<product_box: string, product_name: string, "
                                 "product_price: string, product_link: string>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pages.extract_products(html, site, tasks=7)
        plan = plan_of(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "page_id" in plan and plan.index("REPARTITION_BY_NUM") < plan.index("Join")
    assert [(r.product_name, r.price) for r in found.collect()] == [("N", 5.0)]


def test_snapshot_documents_are_full_and_need_one_exchange(spark):
    """Ids far apart made each product a document of its own."""
    from stallmetrics import schemas
    from stallmetrics.plans import loads
    from stallmetrics.sources import readers

    ids = spark.range(1230).selectExpr("CASE WHEN id < 1200 THEN 'a' ELSE 'b' END AS s", "CAST(id * 1009 AS STRING) AS p")
    products = ids.selectExpr("s AS site_id", "upper(s) AS site_name", "p AS product_id", "concat('n', p) AS product_name",
                              "1.5D AS price", "p AS url", "'c' AS category", "TIMESTAMP'2025-01-01 00:00:00' AS timestamp")
    docs = loads.snapshot_documents(products)
    plan = plan_of(docs)
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(site_id" in plan
    sizes = [len(site["products"]) for r in docs.collect() for site in r.sites.values()]
    assert sum(sizes) == 1230 and max(sizes) <= loads.CHUNK
    assert len(sizes) <= 1200 / loads.CHUNK + 2 * loads.SITE_PARTS
    flat = readers.flatten_snapshot(docs).select(*schemas.PRODUCT_ROWS.names)
    assert sorted(flat.collect()) == sorted(products.select(*schemas.PRODUCT_ROWS.names).collect())


def test_gathered_tables_are_copied_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Backup and rebuild dealt all rows by day again, though each file holds one day."""
    from stallmetrics.sinks import maintenance, tables

    path = str(tmp_path / "t")
    rows = spark.range(2000).selectExpr("id AS order_id", "IF(id % 7 = 0, NULL, DATE'2025-01-01' + CAST(id % 7 AS INT)) AS day", "id % 3 AS v")
    tables.write_clustered(rows, path, "day")
    one = "2025-01-03"
    clean = rows.filter(f"day = DATE'{one}' AND v = 0")
    kept = rows.filter(f"day IS NULL OR day <> DATE'{one}'")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    dealt, plain = [], maintenance.balanced
    monkeypatch.setattr(maintenance, "balanced", lambda df, *c: (dealt.append(df.count()), plain(df, *c))[1])
    monkeypatch.setattr(maintenance, "write_clustered", lambda *a: dealt.append("all"))
    maintenance.backup_table(spark, path, f"{path}-backup", "day")
    assert not dealt
    maintenance.rebuild_table(spark, path, one, clean, f"{path}-new", "day")
    assert dealt == [clean.count()]
    monkeypatch.undo()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    same = lambda a, b: a.select(*b.columns).exceptAll(b).isEmpty() and a.count() == b.count()
    assert same(spark.read.parquet(f"{path}-backup"), rows) and same(spark.read.parquet(f"{path}-new"), kept.unionByName(clean))
    assert tables.cluster_columns(spark, f"{path}-new") == ["order_id"]
    # A table that appends left in small pieces is gathered by the way.
    pieces = str(tmp_path / "pieces")
    rows.repartition(12).write.partitionBy("day").parquet(pieces)
    assert tables.gathered(spark, path) and not tables.gathered(spark, pieces)
    maintenance.backup_table(spark, pieces, f"{pieces}-backup", "day")
    maintenance.rebuild_table(spark, pieces, one, clean, f"{pieces}-new", "day")
    assert tables.gathered(spark, f"{pieces}-backup") and same(spark.read.parquet(f"{pieces}-backup"), rows)
    assert tables.gathered(spark, f"{pieces}-new") and same(spark.read.parquet(f"{pieces}-new"), kept.unionByName(clean))


def test_reconciled_tables_are_computed_once_and_rows_picked_without_a_shuffle(spark):
    from stallmetrics.operators import reconcile

    a = spark.range(3000).selectExpr("id DIV 3 AS order_id", "IF(id % 5 = 0, NULL, DATE'2025-01-01' + CAST(id % 5 AS INT)) AS day", "id AS v")
    b = a.filter("v NOT IN (10, 11)").unionByName(a.filter("v = 40")).selectExpr("IF(v = 77, 0, v) AS v", "day", "order_id")
    found = reconcile.reconcile_rows(a, b, "day", "order_id", pieces=100)
    plan = plan_of(found)
    assert "Range (" not in plan and "hashpartitioning(__day" not in plan.split("BroadcastExchange")[0]
    got = {(str(r.date), r.key, r.side, r["rows"]) for r in found.collect()}
    assert got == {("None", 3, "a", 1), ("2025-01-02", 3, "a", 1), ("None", 13, "b", 1), ("2025-01-03", 25, "a", 1), ("2025-01-03", 25, "b", 1)}
    few = a.filter("v < 2000")
    assert {r["rows"] for r in reconcile.reconcile_rows(a, few, "day", "order_id").select(
        F.sum("rows").alias("rows")).collect()} == {1000} and reconcile.reconcile_rows(a, a, "day", "order_id").isEmpty()


def test_field_tells_which_rows_can_be_among_given_ones(spark, monkeypatch):
    from stallmetrics.operators import cells

    rows = spark.range(-500, 500).select("id", F.xxhash64("id").alias("d"), F.lit(1).alias("word"))
    given = rows.filter("id % 100 = 0")
    found = cells.possible(rows, F.col("d"), cells.field(given, "d"))
    assert found.columns == rows.columns and found.count() == 10 and given.exceptAll(found).isEmpty()
    monkeypatch.setattr(cells, "WORDS", 2)  # a small field keeps few out, and loses none
    found = cells.possible(rows, F.col("d"), cells.field(given, "d"))
    assert given.exceptAll(found).isEmpty() and 10 < found.count() < 300
    assert cells.possible(rows, F.col("d"), cells.field(given.limit(0), "d")).isEmpty()


def test_stored_rows_are_not_dealt_again(spark, tmp_path, monkeypatch):
    """A second delivery shuffled all its rows whole, and a repair all rows of its days."""
    from stallmetrics.operators import ingest, key_index, repair
    from stallmetrics.plans.views import order_items, order_items_dup
    from stallmetrics.sinks import tables

    day = F.trunc("order_created_date_tr", "MM")
    rows = ingest.conform(order_items_dup(spark, SMALLEST).withColumn("order_created_date_tr", day)).localCheckpoint()
    late = F.col("order_created_date_tr") < "1996-01-01"
    whole = ingest.conform(order_items(spark, SMALLEST)).count()
    seen, plain = [], ingest.dealt
    monkeypatch.setattr(ingest, "dealt", lambda df, *a: (seen.append(df.count()), plain(df, *a))[1])
    for name in ("", "keys_again"):
        path = str(tmp_path / f"t{name}")
        if name:
            key_index.create_index(spark, path, name, unit="year")
        take = lambda df: key_index.ingest_indexed(df, path, name) if name else ingest.ingest_batch(df, path)
        first, second, third = take(rows.filter(~late)), take(rows), take(rows)
        assert first["inserted"] + second["inserted"] == whole and third == ingest.outcome(rows.count(), 0)
        assert seen[-1] == 0 and rows.filter(late).count() <= seen[-2] < rows.filter(late).count() * 1.2 and len(seen) == 3
        seen.clear()
        if name:
            assert spark.table(name).count() == whole
    monkeypatch.undo()
    table = str(tmp_path / "copies")
    tables.write_clustered(rows, table)
    monkeypatch.setattr(repair, "dealt", lambda df, *a: (seen.append(df.count()), plain(df, *a))[1])
    report = repair.repair_dates(spark, table, f"{table}-backup").agg(F.sum(F.col("rows_before") - F.col("rows_after")), F.sum("duplicates_left")).first()
    assert tuple(report) == (rows.count() - whole, 0) and len(seen) == 1 and seen[0] < rows.count() / 10
    assert spark.read.parquet(table).count() == whole and spark.read.schema(rows.schema).parquet(table).select(*rows.columns).exceptAll(rows.distinct()).isEmpty()
