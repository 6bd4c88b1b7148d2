"""Keyed state and first-wins streams on hand-made files."""

from datetime import datetime

from pyspark.sql import Row
from pyspark.sql import functions as F

from stallmetrics.session import new_workdir
from stallmetrics.streaming import ingest as stream
from stallmetrics.streaming import keyed
from tests.conftest import rows
from tests.test_prices import products


def run_of(spark, n, data):
    df = products(spark, [(s, p, price or 0, "x") for s, p, price in data]).withColumn("run_id", F.lit(n).cast("long"))
    df = df.withColumn("pos", F.monotonically_increasing_id())
    return df.withColumn("price", F.when(F.col("price") > 0, F.col("price"))).coalesce(1)


def land(spark, base, runs, **options):
    for run in runs:
        run.write.mode("append").parquet(base + "/in")
        source = spark.readStream.schema(run.schema).parquet(base + "/in")
        keyed.stream_keyed_changes(source, base + "/log", base + "/cp", ["pos"], **options).awaitTermination()
    return rows(spark.read.parquet(base + "/log"), "run_id", "site_id", "product_id", "old_price", "new_price")


RUNS = [[("a", "1", 1), ("a", "2", 2), ("b", "1", 5), ("c", "1", None)],
        [("a", "1", 3), ("a", "1", 2), ("b", "1", 5), ("c", "1", 4)],  # the last row of a product counts
        [("a", "1", 2), ("a", "2", 9), ("b", "1", 6), ("c", "1", 5)]]


def test_changes_come_from_the_run_before_and_survive_restarts(spark):
    runs = [run_of(spark, n, data) for n, data in enumerate(RUNS)]
    got = land(spark, new_workdir(spark, "k"), [*runs, runs[-1], runs[0]])  # the last again, then one long past
    assert got == [(1, "a", "1", 1.0, 2.0), (2, "b", "1", 5.0, 6.0), (2, "c", "1", 4.0, 5.0)]


def test_unseen_products_keep_their_price_if_asked(spark):
    runs = [run_of(spark, n, data) for n, data in enumerate(RUNS)]
    got = land(spark, new_workdir(spark, "k"), runs, keep_unseen=True)
    assert (2, "a", "2", 2.0, 9.0) in got and len(got) == 4


def test_several_runs_in_one_batch(spark):
    base = new_workdir(spark, "k")
    both = run_of(spark, 0, RUNS[0]).unionByName(run_of(spark, 1, RUNS[1])).unionByName(run_of(spark, 2, RUNS[2]))
    assert land(spark, base, [both]) == [(1, "a", "1", 1.0, 2.0), (2, "b", "1", 5.0, 6.0), (2, "c", "1", 4.0, 5.0)]


def test_products_share_values_of_the_state_store(spark):
    """One call to the store for each bucket of a run, not for each product."""
    base = new_workdir(spark, "k")
    runs = [run_of(spark, n, data) for n, data in enumerate(RUNS)]
    assert land(spark, base, [*runs, runs[-1]], buckets=1) == [(1, "a", "1", 1.0, 2.0), (2, "b", "1", 5.0, 6.0), (2, "c", "1", 4.0, 5.0)]
    held = spark.read.format("statestore").option("stateVarName", "last_prices").load(base + "/cp")
    assert held.count() == 1 and held.selectExpr("json_array_length(value.products)").first()[0] == 4
    assert keyed.buckets_for(spark.range(1000).selectExpr("'s' AS site_id", "CAST(id AS STRING) AS product_id")) in range(8, 13)


def test_a_product_is_forgotten_though_others_of_its_bucket_are_seen():
    class Held:
        value = None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Clock:
        def __init__(self, ms):
            self.getCurrentProcessingTimeInMs = lambda: ms

    fields = "run_id site_id product_id site_name product_name price url category position_0".split()
    row = lambda run, product, price: Row(*fields)(run, "s", product, "S", "P", price, "/", "c", 1)
    processor = keyed.LastPrices(1, True, 100)
    processor.held = Held()
    told = lambda ms, *given: [(r.product_id, r.old_price, r.new_price) for r in processor.handleInputRows((0,), iter(given), Clock(ms))]
    assert told(0, row(0, "a", 1.0), row(0, "b", 1.0)) == []
    assert told(60, row(1, "a", 2.0)) == [("a", 1.0, 2.0)]
    assert told(100, row(2, "a", 3.0), row(2, "b", 3.0)) == [("a", 2.0, 3.0)]


def test_changes_are_read_from_the_written_state(spark):
    from stallmetrics.streaming import changes

    base = new_workdir(spark, "c")
    for n in (0, 1, 2, 1, 2):  # two runs are repeated
        changes.detect_run(run_of(spark, n, RUNS[n]), n, base + "/state", base + "/log", ["pos"])
    assert rows(changes.read_change_log(spark, base + "/log"), "run_id", "site_id", "product_id", "old_price", "new_price") == [
        (1, "a", "1", 1.0, 2.0), (2, "b", "1", 5.0, 6.0), (2, "c", "1", 4.0, 5.0)]
    state = spark.read.parquet(base + "/state/snapshot_id=1")
    assert rows(state, "site_id", "product_id", "price", "old_price") == [("a", "1", 2.0, 1.0), ("b", "1", 5.0, 5.0), ("c", "1", 4.0, None)]


def test_first_row_wins_until_the_watermark(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    line = '{"order_id": %d, "order_created_date": "%sT00:00:00", "order_creation_timestamp": "%sT10:00:00", "order_amount": %d}\n'
    item = lambda k, day, amount: line % (k, day, day, amount)
    late = 0
    for n, text in enumerate([
            item(1, "2025-11-01", 5) + item(2, "2025-11-20", 5) + item(2, "2025-11-20", 5),
            item(2, "2025-11-20", 7) + item(3, "2025-11-15", 5) + item(4, "2025-11-02", 5),  # 4 is late, 2 known
            '{"order_id": 5}\n']):
        (landing / f"{n}.json").write_text(text)
        running = stream.stream_first_wins(spark, str(landing), f"{tmp_path}/t", f"{tmp_path}/cp")
        running.awaitTermination()
        late += stream.stream_totals(running)["late"]
    got = rows(spark.read.parquet(f"{tmp_path}/t"), "order_id", "order_amount")
    assert [k for k, _ in got] == [1, 2, 3] and late == 2
    assert got[1][1] == 5
    assert spark.read.parquet(f"{tmp_path}/t").agg(F.max("order_creation_timestamp")).first()[0] == datetime(2025, 11, 20, 10)
