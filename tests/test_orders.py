"""Order metrics, audits and row selection on hand-made rows."""

import random
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallmetrics import schemas
from stallmetrics.operators import dedupe, ordered, quality, sales
from tests.conftest import one, plan_of, rows

NAMES = schemas.ORDER_ITEMS.fieldNames()
D1, D2, D3 = date(2025, 11, 4), date(2025, 11, 5), date(2025, 11, 6)


def item(order_id, day=D1, **over):
    base = dict.fromkeys(NAMES)
    stamp = None if day is None else datetime(day.year, day.month, day.day, 9)
    base.update(order_id=order_id, order_created_date_tr=day, product_code_1="p1", user_id="u1", city="c1",
                order_creation_timestamp=stamp, order_delivery_date=day)
    base.update(over)
    return tuple(base[n] for n in NAMES)


@pytest.fixture(scope="module")
def items(spark):
    from decimal import Decimal

    amount = lambda x: Decimal(x)
    return spark.createDataFrame([
        item(1, order_amount=amount("10.00"), order_code="A"), item(1, order_amount=amount("10.00"), order_code="A"),
        item(1, product_code_1="p2", order_amount=amount("5.50")),
        item(2, D2, order_amount=None, user_id="", city=None), item(2, D2, order_amount=amount("1.00"), city="c2"),
        item(3, D3, order_amount=amount("2.00"), order_creation_timestamp=None), item(1, D2, order_amount=amount("4.00")),
        item(None, D2, order_amount=amount("8.00"), product_code_1=None), item(9, None, order_amount=amount("7.00")),
    ], schemas.ORDER_ITEMS).cache()


def test_daily_summary(items):
    assert rows(sales.daily_summary(items)) == [
        (D1, 1, 3, 25.5, 8.5), (D2, 2, 4, 13.0, 13.0 / 3), (D3, 1, 1, 2.0, 2.0)]


def test_totals_count_each_order_once(items):
    assert one(sales.totals(items)) == (3, 8, 40.5, 40.5 / 7, 3)


def test_kpis_match_totals(items):
    assert one(sales.kpis(items, F.lit(True)))[:5] == one(sales.totals(items))


def test_growth_without_base_is_null(items):
    got = sales.growth(items, D1, D2, "previous_period").first()
    assert (got.total_orders, got.base_orders, got.growth_orders, got.growth_revenue) == (2, 0, None, None)


def test_growth_overlapping_ranges(items):
    got = sales.growth(items, D2, D3 + timedelta(days=29), "previous_month").first()
    assert (got.total_orders, got.total_revenue) == (3, 15.0)


def test_growth_value(items):
    got = sales.growth(items, D2, D2, "previous_period").first()
    assert (got.total_orders, got.base_orders, got.growth_orders) == (2, 1, 100.0)
    assert got.growth_revenue == pytest.approx((13 - 25.5) / 25.5 * 100)


def daily(spark, counts):
    return spark.createDataFrame([(D1 + timedelta(days=i), c) for i, c in enumerate(counts)], "date date, unique_orders long")


@pytest.mark.parametrize("counts,direction", [
    ([10] * 7 + [12] * 7, "up"), ([10] * 7 + [8] * 7, "down"), ([10] * 7 + [11] * 7, "stable"),
    ([1, 100], "stable"), ([500] * 30 + [10] * 7 + [12] * 7, "up")])
def test_momentum(spark, counts, direction):
    assert sales.momentum(daily(spark, counts)).first().direction == direction


def test_momentum_needs_two_days(spark):
    assert sales.momentum(daily(spark, [5])).count() == 0


def test_cities_merge_after_or_before_ranking(spark):
    data = [(i, c, 1.0) for i, c in enumerate(["İstanbul (Avrupa)", "ISTANBUL-AVRUPA", "Ankara", "Ankara"])]
    data.append((0, "ISTANBUL-AVRUPA", 1.0))  # order 0 under both spellings
    df = spark.createDataFrame(data, "order_id long, city string, order_amount double")
    assert rows(sales.top_cities_normalized(df, F.lit(True)), "city_display", "unique_orders") == [
        ("Ankara", 2), ("ISTANBUL-AVRUPA", 3)]
    assert rows(sales.top_cities_normalized(df, F.lit(True), merge_first=True), "city_display", "unique_orders") == [
        ("Ankara", 2), ("ISTANBUL-AVRUPA", 2)]


def test_weekday_matrix_has_all_hours(items):
    got = sales.weekday_hour_pivot(items, F.lit(True))
    assert got.columns == ["day_of_week", "day_label", *[f"h{h:02d}" for h in range(24)]]
    assert rows(got, "day_of_week", "day_label", "h09", "h10") == [(3, "Sal", 1, 0), (4, "Çar", 2, 0)]


def test_order_list_rejects_other_limits(items):
    with pytest.raises(ValueError):
        sales.order_list(items, F.lit(True), 123)


def test_order_list_display(items):
    shown = sales.order_list_display(sales.order_list(items, F.lit(True), 100)).filter("`Sipariş ID` = 3").first()
    assert shown["Sipariş Tutarı"] == "₺2.00" and shown["Sipariş Zamanı"] is None


def test_duplicate_summary(items):
    assert one(quality.duplicate_summary(items, D1)) == (3, 1, 2, 1, 3.0)
    assert one(quality.duplicate_summary(items, "2031-01-01")) == (0, 0, 0, 0, None)


def test_health_counts_order_size_over_the_span(items):
    got = {r.date: r for r in quality.health_by_day(items, D3, 7).collect()}
    assert (got[D2].single_item_orders, got[D2].multi_item_orders) == (0, 2)
    assert got[D3].single_item_orders == 1
    assert (got[D1].status, got[D2].status) == (quality.HAS_DUPLICATES, quality.CLEAN)


def test_health_line_text(items):
    assert quality.health_line(items, D1).first().status == "⚠️ 1 DUPLICATE VAR!"
    assert quality.health_line(items, D2).first().status == "✅ TEMİZ"


def test_health_today_span(spark):
    df = spark.createDataFrame([
        item(1, order_creation_timestamp=datetime(2025, 11, 4, 1, 30)),
        item(2, order_creation_timestamp=datetime(2025, 11, 4, 4, 29))], schemas.ORDER_ITEMS)
    assert quality.health_today(df, D1).first().span_hours == 2


def test_null_audit(items):
    assert one(quality.null_audit(items))[1:] == (9, 1, 1, 1, 1, 2)


def test_duplicate_groups_and_details(items):
    group = quality.duplicate_groups(items).first()
    assert (group.order_id, group.product_code_1, group.duplicate_count) == (1, "p1", 2)
    assert quality.duplicate_order_details(items).count() == 4
    assert rows(quality.duplicate_samples(items).groupBy("order_id", "duplicate_count").count()) == [(1, 4, 4), (2, 2, 2)]


def test_monthly_coverage_counts_an_order_both_ways(items):
    got = quality.monthly_coverage(items, "2025-01-01", "2026-01-01").first()
    assert (got.total_orders, got.orders_with_code, got.orders_without_code) == (3, 1, 3)
    assert (got.year_month, got.month_name, got.code_coverage_pct) == ("2025-11", "November 2025", 33.33)


def test_reconcile_days_finds_missing_day(spark, items):
    older = items.filter(F.col("order_created_date_tr") != D2).withColumnRenamed(
        "order_created_date_tr", "order_created_date")
    got = {r.date: (r.rows_diff, r.orders_diff) for r in quality.reconcile_days(items, older).collect()}
    assert got == {D1: (0, 0), D2: (4, 2), D3: (0, 0)}
    with pytest.raises(ValueError):
        quality.date_column(items.select("city"))


def test_dedupe_keeps_items_of_an_order(items):
    assert dedupe.dedupe_exact(items).count() == 8
    assert rows(dedupe.dedupe_exact(items)) == rows(dedupe.dedupe_fingerprint(items))
    once = dedupe.dedupe_exact(items)
    assert rows(dedupe.dedupe_exact(once)) == rows(once)


def test_latest_counts_missing_time_as_newest(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, datetime(2025, 1, 1), "b"), (2, datetime(2025, 1, 1), "c")],
                               "k int, ts timestamp, v string")
    assert rows(dedupe.dedupe_latest(df, ["k"], "ts"), "v") == [("a",), ("c",)]


def test_first_and_last(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("l", 3, "c")], "k string, pos int, v string")
    assert rows(dedupe.keep_first(df, ["k"], ["pos"]), "v") == [("a",), ("c",)]
    assert rows(dedupe.keep_last(df, ["k"], ["pos"]), "v") == [("b",), ("c",)]
    assert rows(dedupe.first_n(df, [], 2, ["pos"]), "v") == [("a",), ("b",)]


@pytest.mark.parametrize("make", [
    lambda df: dedupe.dedupe_latest(df, ["order_id"], "order_creation_timestamp"),
    lambda df: dedupe.keep_first(df, ["order_id"], ["order_delivery_date"]),
    lambda df: dedupe.first_n(df, ["city"], 20, ["order_id"])])
def test_selection_limits_groups_before_the_shuffle(items, make):
    """A hot key must not travel whole: a group limit sits on both sides of the exchange."""
    plan = plan_of(make(items))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def skewed(seed, n=400):
    """A third of the rows under one key, some null keys, values and equal months."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [("hot" if i % 3 == 0 else rng.choice(["a", "b", None]), start + timedelta(hours=rng.randrange(3000)), i,
             rng.choice([1.0, 2.0, None])) for i in range(n)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000), per_task=st.sampled_from([1, 3, 24]))
def test_split_windows_equal_plain_windows(spark, seed, per_task):
    df = spark.createDataFrame(skewed(seed), "k string, ts timestamp, id int, v double")
    w = W.partitionBy("k").orderBy("ts", "id")
    want = rows(df.select("id", F.lag("v").over(w), F.row_number().over(w).cast("long")))
    split = ordered.previous_value(df, ["k"], ["ts", "id"], "v", per_task=per_task)
    numbered = ordered.running_index(split, ["k"], ["ts", "id"], per_task=per_task)
    assert rows(numbered, "id", "previous", "index") == want
    assert numbered.schema["index"].dataType.simpleString() == "bigint"


def test_a_key_with_nearly_all_rows_is_many_tasks(spark):
    data = [("hot" if i % 50 else f"k{i}", i, float(i % 7)) for i in range(5000)]
    df = spark.createDataFrame(data, "k string, id int, v double").repartition(3)
    cuts = ordered.cut_points(df, ["k"], ["id"]).collect()
    assert [c["key"]["k"] for c in cuts] == ["hot"] and len(cuts[0]["cuts"]) >= 3
    got = ordered.previous_value(df, ["k"], ["id"], "v")
    w = W.partitionBy("k").orderBy("id")
    assert rows(got) == rows(df.withColumn("previous", F.lag("v").over(w)))
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("Scan ExistingRDD") == 1 and "ReusedExchange" in final
    pieces = ordered._pieces(df, ["k"], ["id"], ordered.cut_points(df, ["k"], ["id"]))
    sizes = [r["count"] for r in pieces.groupBy("__group").count().collect()]
    assert max(sizes) < 0.7 * 5000
    assert ordered.cut_points(df.limit(0), ["k"], ["id"]) is None
    assert ordered.running_index(df.limit(0), ["k"], ["id"]).count() == 0


def test_first_n_beyond_the_group_limit(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 5 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    got = dedupe.first_n(df, ["k"], 1500, ["id"])
    assert got.filter("k = 'hot'").count() == 1500 and got.count() == 2500
    assert got.filter("k = 'hot'").agg(F.max("id")).first()[0] == 1874
    with pytest.raises(ValueError, match="names"):
        dedupe.first_n(df, ["k"], 1500, [F.desc("id")])


def test_index_over_the_whole_table(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 900, "hot").otherwise("x").alias("k")).repartition(7)
    got = ordered.table_index(df, ["k", "id"])
    assert got.filter(F.col("index") != F.col("id") + 1).count() == 0 and got.count() == 1000
    assert ordered.table_index(df.limit(0), ["id"]).count() == 0


def test_distinct_counts_shuffle_by_order_too(items):
    """One hot city must not land in one task: the first exchange is keyed by (city, order)."""
    plan = plan_of(sales.top_cities(items))
    assert "hashpartitioning(city" in plan and "order_id" in plan.split("hashpartitioning(city")[-1][:40]
