"""Reconciliation, roll-ups, sketches, clustering and changing payloads on hand-made rows."""

import json
import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, LongType, StringType, StructField, StructType

from stallmetrics.functions.filters import between_days
from stallmetrics.operators import frequent, reconcile, rollup, sales
from stallmetrics.schemas import PARTITION_COLUMN as DAY
from stallmetrics.session import new_workdir
from stallmetrics.sinks import clustering
from stallmetrics.sources import variants
from tests.conftest import one, rows

D = [date(2025, 1, k) for k in range(1, 29)]
FACT = f"order_id long, vendor_id long, city string, payment_method string, order_amount decimal(18,2), {DAY} date"


def fact(spark, seed=1, n=400):
    rng = random.Random(seed)
    pick = lambda values: rng.choice(values)
    data = [(pick([None, 0, -1, -40_000, *range(1, 90)]), pick([None, 1, 2, 3]), pick([None, "X", "Y", ""]), pick(["a", "b", None]),
             pick([None, Decimal("1.25"), Decimal("3")]), pick([None, *D])) for _ in range(n)]
    return spark.createDataFrame(data, FACT)


# --- reconciliation ---------------------------------------------------------------------

def test_reconcile_counts_copies_and_missing_days(spark):
    a = spark.createDataFrame([(1, D[0], "x"), (1, D[0], "x"), (2, D[0], None), (3, None, "z"), (4, D[1], "q")], f"order_id long, {DAY} date, v string")
    b = spark.createDataFrame([("x", 1, D[0]), ("y", 2, D[0]), ("z", 3, None), ("n", None, D[2])], f"v string, order_id long, {DAY} date")
    got = rows(reconcile.reconcile_rows(a, b), "date", "key", "side", "rows")
    assert got == sorted([(D[0], 1, "a", 1), (D[0], 2, "a", 1), (D[0], 2, "b", 1), (D[1], 4, "a", 1), (D[2], None, "b", 1)],
                         key=lambda t: tuple((v is None, str(v)) for v in t))
    assert rows(reconcile.differing_days(a, b)) == [(D[0],), (D[1],), (D[2],)]
    assert reconcile.reconcile_rows(a, a).count() == 0 and reconcile.differing_days(a, a.repartition(3)).count() == 0
    assert reconcile.reconcile_rows(a, a.limit(0)).agg(F.sum("rows")).first()[0] == 5
    with pytest.raises(ValueError, match="columns"):
        reconcile.reconcile_rows(a, b.drop("v"))


@pytest.mark.parametrize("pieces", [1, 7])
def test_reconcile_equals_except_all(spark, pieces):
    a, b = fact(spark, 1), fact(spark, 1).filter("order_id % 5 <> 0").unionByName(fact(spark, 2, 30))
    surplus = lambda x, y, side: x.exceptAll(y).groupBy(F.col(DAY).alias("date"), F.col("order_id").alias("key")).agg(
        F.lit(side).alias("side"), F.count("*").alias("rows"))
    want = surplus(a, b, "a").unionByName(surplus(b, a, "b"))
    assert rows(reconcile.reconcile_rows(a, b, pieces=pieces), "date", "key", "side", "rows") == rows(want, "date", "key", "side", "rows")


# --- roll-ups and sketches --------------------------------------------------------------

def same(a, b):
    return a.select(*sorted(a.columns)).collect() == b.select(*sorted(a.columns)).collect()


@pytest.mark.parametrize("make", [lambda: F.lit(True), lambda: between_days(D[3], D[20]), lambda: F.col("payment_method") == "a",
                                  lambda: between_days("2030-01-01", "2030-01-02")])
def test_rollup_answers_like_the_fact(spark, make):
    flt = make()
    path = new_workdir(spark, "rollup") + "/daily"
    df = fact(spark)
    rollup.build(df, path, ["payment_method"])
    parts = rollup.load(spark, path)
    dated = flt & F.col(DAY).isNotNull()
    assert same(rollup.kpis(parts, flt), sales.kpis(df, dated))
    assert same(rollup.avg_daily_revenue(parts, flt), sales.avg_daily_revenue(df, dated))


def test_rollup_growth_and_refresh_of_a_day(spark):
    path = new_workdir(spark, "rollup") + "/daily"
    before, after = fact(spark, 3), fact(spark, 3).filter(F.col(DAY) != D[9]).unionByName(fact(spark, 4).filter(F.col(DAY) == D[9]))
    later = before.withColumn(DAY, F.add_months(DAY, 2))
    rollup.build(before.unionByName(later), path, ["payment_method"])
    rollup.refresh(after.unionByName(later), path, ["payment_method"], [D[9]])
    parts = rollup.load(spark, path)
    assert same(rollup.kpis(parts, F.lit(True)), sales.kpis(after.unionByName(later), F.lit(True)))
    for start, end in ((D[8], D[14]), (date(2025, 6, 1), date(2025, 6, 3))):
        assert same(rollup.growth(parts, start, end), sales.growth(after.unionByName(later), start, end))
    rollup.refresh(later, path, ["payment_method"], [D[0]])  # a month that has no rows any more
    assert same(rollup.kpis(rollup.load(spark, path), F.lit(True)), sales.kpis(later, F.lit(True)))


def test_frequent_items_find_most_of_the_exact_top(spark):
    rng = random.Random(8)
    data = [(D[rng.randrange(28)], int(rng.paretovariate(0.6)) % 20_000) for _ in range(20_000)]
    df = spark.createDataFrame(data, f"{DAY} date, item long")
    path = new_workdir(spark, "sketch") + "/kept"
    frequent.sketches(df, "item", tracked=256).write.parquet(path)
    flt = between_days(D[2], D[25])
    got = frequent.top_items(spark.read.parquet(path), flt, 20, tracked=256).collect()
    counts = {r[0]: r[1] for r in df.filter(flt).groupBy("item").count().collect()}
    exact = sorted(counts, key=lambda k: (-counts[k], k))[:20]
    recall = len({r["item"] for r in got} & set(exact)) / 20
    assert recall >= 0.9
    assert all(abs(r["estimate"] - counts[r["item"]]) <= r["error_bound"] for r in got)
    assert frequent.top_items(spark.read.parquet(path), between_days("2030-01-01", "2030-01-02"), 5).count() == 0


# --- clustering -------------------------------------------------------------------------

def test_interleaved_files_are_skipped_by_both_columns(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(i, rng.randrange(1000), None if i % 50 == 0 else f"k{rng.randrange(500):03d}", i % 2) for i in range(6000)],
                               "id long, a int, b string, part int")
    base = new_workdir(spark, "z")
    clustering.write_interleaved(df, base + "/z", ["a", "b"], "part", bloom=["b"], files=64)
    stored = spark.read.parquet(base + "/z")
    assert rows(stored, "id", "a", "b", "part") == rows(df, "id", "a", "b", "part")
    files = clustering.file_bounds(stored, ["a", "b"]).count()
    assert files >= 40
    for column, keys in (("a", [10, 500, 990]), ("b", ["k010", "k250", "k480"])):
        opened = [r["files"] for r in clustering.files_opened(stored, column, keys).collect()]
        assert max(opened) <= files / 2
    assert clustering.column_cuts(df.limit(0), "a") == []


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(x, y) for x in range(4) for y in range(4)], "x int, y int")
    z = df.select("x", "y", clustering.interleaved([F.col("x"), F.col("y")], 2).alias("z")).collect()
    spread = lambda v: (v & 1) | (v & 2) << 1
    assert all(r["z"] == spread(r["x"]) << 1 | spread(r["y"]) for r in z)


# --- changing payloads ------------------------------------------------------------------

SCHEMA = StructType([StructField("order_id", LongType()), StructField("order_amount", DecimalType(18, 2)),
                     StructField("city", StringType()), StructField("tags", ArrayType(StringType()))])


def test_no_field_of_a_changing_payload_is_lost(spark, tmp_path):
    lines = ['{"order_id": 1, "order_amount": "12.50", "city": "X", "tags": ["a", null]}',
             '[{"order_id": "no", "city": {"name": "Y"}, "new": [1, 2]}, {"order_id": 3, "city": null}, 7]',
             "[]", "", "{broken", '"text"', '{"order_id": 4, "tags": "one", "a.b": true}']
    (tmp_path / "p.json").write_text("\n".join(lines))
    got = variants.read_changing_payload(spark, str(tmp_path), SCHEMA)
    found = sorted(((r["order_id"], r["order_amount"], r["city"], r["tags"], r["rest"]) for r in got.collect()), key=str)
    rest = lambda r: {k: json.loads(v) if k else v for k, v in (r[4] or {}).items()}
    by_id = {r[0]: r for r in found if r[0] is not None}
    assert by_id[1][1:4] == (Decimal("12.50"), "X", ["a", None]) and rest(by_id[1]) == {}
    assert by_id[3][2] is None and rest(by_id[3]) == {}
    assert rest(by_id[4])["a.b"] is True
    others = [rest(r) for r in found if r[0] is None]
    assert {"order_id": "no", "city": {"name": "Y"}, "new": [1, 2]} in [
        {**o, "city": o.get("city", {"name": "Y"})} for o in others if "new" in o]
    assert {"": "{broken"} in others and {"": "7"} in others and {"": '"text"'} in others and len(found) == 7
    names = {r["field"] for r in variants.unknown_fields(got).collect()}
    assert {"new", "a.b", ""} <= names
    (tmp_path / "q").mkdir()
    (tmp_path / "q" / "p.json").write_text('[\n {"order_id": 5},\n {"order_id": 6, "x": 1}\n]')
    assert variants.read_changing_payload(spark, str(tmp_path / "q"), SCHEMA, wholetext=True).count() == 2


def test_schema_of_a_changing_payload(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"a": 1, "b": "x"}\n{"a": 2, "c": {"d": true}}\n{broken')
    text = one(variants.found_schema(variants.parsed_lines(spark, str(tmp_path))))[0]
    assert text == "OBJECT<a: BIGINT, b: STRING, c: OBJECT<d: BOOLEAN>>"
