"""The review loop as a stream: batches of new products matched against a history that grows with each batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexalign.operators.matching import Settings
from lexalign.operators.review import build_queue


def feed(spark: SparkSession, products: DataFrame, formula: str, cands: DataFrame, history_path: str, sink: Callable[[DataFrame, DataFrame, int], None], settings: Settings = Settings(), **options):
    """Starts a query over a stream of products (row_id, formula).

    Each batch is matched with the history of the batches before; what it adds goes to a new folder of history_path
    named by the batch, so that a batch that is run again replaces its own addition. sink gets the recomposed
    products, the queue and the batch's number.
    """
    def batch(df: DataFrame, n: int) -> None:
        own = df.sparkSession
        old = own.createDataFrame([], "hist_norm string, hist_name string")
        for k in range(n):
            try:
                old = old.unionByName(own.read.parquet(f"{history_path}/batch={k}"))
            except Exception as e:  # noqa: BLE001
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        old = old.dropDuplicates(["hist_norm"])
        recomposed, queue, new = build_queue(df, formula, cands, old, settings)
        new.join(old.select("hist_norm"), "hist_norm", "left_anti").write.mode("overwrite").parquet(f"{history_path}/batch={n}")
        sink(recomposed, queue, n)

    return products.writeStream.foreachBatch(batch).options(**options).start()


def decisions_stream(events: DataFrame, ts: str, norm: str, decision: str, delay: str = "1 day", window: str = "1 hour") -> DataFrame:
    """Counts of decisions by hour and kind from a stream, late ones within delay included."""
    return events.withWatermark(ts, delay).groupBy(F.window(ts, window).alias("w"), decision).agg(F.count(norm).alias("n"))
