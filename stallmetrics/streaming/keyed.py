"""Price changes across runs from keyed state: the last price of each product.

``changes.detect_run`` rewrites the whole state with every run. Here a run reads and writes the state of
what it delivers. A call to the state store costs far more than the product it is about, so products are held
in buckets, some ``PER_BUCKET`` to a value (see ``buckets_for``); a value beyond 8 KB comes in two
packets, which may cost a delay of 40 ms each. The store needs the RocksDB provider (``STATE_STORE``),
which keeps it on disk.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from stallmetrics.operators.pricing import KEY

# The processor travels with its tasks, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_STORE = {"spark.sql.streaming.stateStore.providerClass":
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
OUTPUT = ("run_id long, site_id string, product_id string, site_name string, product_name string, old_price double, "
          "new_price double, price_diff double, url string, category string")
#: A list of [site, product, run, price, time seen] as JSON text; the time only if products are forgotten.
STATE = "products string"
PER_BUCKET = 100
BUCKETS = 4096


class LastPrices(StatefulProcessor):
    """Holds the run and price in which a product was last seen.

    Of several rows of a product in one run the last by position counts. With ``keep_unseen`` the
    price before is that of the last run which had the product, however long ago, otherwise only
    that of the run just before. Rows of the run that is already held replace it; rows of older runs
    change nothing. A product not seen for ``forget_ms`` is forgotten.
    """

    def __init__(self, positions: int, keep_unseen: bool, forget_ms: int | None):
        self.fields = [f"position_{k}" for k in range(positions)]
        self.keep_unseen, self.forget_ms = keep_unseen, forget_ms

    def place(self, row: Row) -> tuple:
        """Sortable position of a row, nulls first."""
        return tuple((row[k] is not None, row[k]) if row[k] is not None else (False,) for k in self.fields)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("last_prices", STATE, self.forget_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.forget_ms else None
        newest: dict[tuple, dict[int, Row]] = {}
        for row in rows:
            runs = newest.setdefault((row.site_id, row.product_id), {})
            if row.run_id not in runs or self.place(row) > self.place(runs[row.run_id]):
                runs[row.run_id] = row
        state = self.held.get()
        known = {(p[0], p[1]): p[2:] for p in json.loads(state[0])} if state else {}
        if self.forget_ms:
            known = {p: last for p, last in known.items() if last[2] + self.forget_ms > now}
        for product, runs in newest.items():
            before = known.get(product)
            for run_id in sorted(runs):
                row = runs[run_id]
                if before is not None and run_id < before[0]:
                    continue
                told = before is not None and run_id > before[0] and (self.keep_unseen or run_id == before[0] + 1)
                if told and row.price is not None and before[1] is not None and row.price != before[1]:
                    yield Row(run_id=run_id, site_id=row.site_id, product_id=row.product_id, site_name=row.site_name,
                              product_name=row.product_name, old_price=before[1], new_price=row.price,
                              price_diff=row.price - before[1], url=row.url, category=row.category)
                before = (run_id, row.price)
            known[product] = (*before[:2], now) if self.forget_ms else before[:2]
        self.held.update((json.dumps([[*p, *last] for p, last in known.items()], separators=(",", ":")),))

    def close(self) -> None:
        pass


def keyed_changes(observations: DataFrame, position: list[str], keep_unseen: bool = False,
                  forget_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Price changes of a stream of observations with a ``run_id`` that counts the runs.

    Buckets of products are spread by the state store's partitions; the rows that one run delivers
    for a bucket pass by one at a time, and the last of each product is held until all have passed.
    A checkpoint keeps its number of buckets.
    """
    rows = observations.select(
        *KEY, F.col("run_id").cast("long").alias("run_id"), "site_name", "product_name", F.col("price").cast("double").alias("price"),
        "url", "category", *[F.col(c).alias(f"position_{k}") for k, c in enumerate(position)])
    mode = "ProcessingTime" if forget_ms else "None"
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(*KEY), F.lit(buckets)))
    return dealt.groupBy("bucket").transformWithState(LastPrices(len(position), keep_unseen, forget_ms), OUTPUT, "Append", mode)


def buckets_for(products: DataFrame) -> int:
    """Number of buckets for about as many products as occur in a table."""
    return max(1, products.agg(F.approx_count_distinct(F.xxhash64(*KEY))).first()[0] // PER_BUCKET)


def stream_keyed_changes(observations: DataFrame, log: str, checkpoint: str, position: list[str], keep_unseen: bool = False,
                         forget_ms: int | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """Append the changes of all runs that have arrived to a Parquet log, each once."""
    spark = observations.sparkSession
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    changes = keyed_changes(observations, position, keep_unseen, forget_ms, buckets)
    writer = changes.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(log)
