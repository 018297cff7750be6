"""The newest click of each place in Spark's state store, so that older ones never reach the log.

The state of a key (request and reviewer) has for each place of clicks (the answer, or position and step of a chunk) the
order of its newest click: event time, then the ties. A click passes if it comes after that, whatever the order of arrival,
and goes to the log of clicks that ``read_feedback`` reduces. So a reviewer's clicks on a request cost one look into the
store together, and a state has as many places as the trace of its request. The state of a key ends some time after its
last newest click; an older click that comes later still passes then, and readers leave it out, as event time decides
there too. So state is bounded by the keys of that time, and nothing depends on it being there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import TimerValues

from answerloom.streaming.incremental import reduce_feedback, write_batch

#: The store that keeps state with an end; and no batches without clicks, which a run that is to stop would go on with.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
#: Milliseconds after which the state of a key that gets no newer click ends.
KEPT_MS = 30 * 24 * 3600 * 1000

#: What the newest click is kept of, and the part of it that has one state.
KEY = ("request_id", "reviewer", "anonymous", "place")
STATE_KEY = KEY[:3]
#: Keeps the microseconds of event times.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "ignoreNullFields": "false"}


def sortable(column: Column, kind: T.DataType) -> Column:
    """Text in the order of the values; null comes first."""
    if isinstance(kind, T.TimestampNTZType):
        column, kind = F.to_timestamp(column), T.TimestampType()
    if isinstance(kind, T.TimestampType):
        column, kind = F.unix_micros(column), T.LongType()
    if isinstance(kind, T.IntegralType):
        shifted = column.cast("decimal(20,0)") + F.lit(Decimal(1 << 63)).cast("decimal(20,0)")
        return F.coalesce(F.lpad(shifted.cast("decimal(20,0)").cast("string"), 20, "0"), F.lit(""))
    if isinstance(kind, T.StringType):
        return F.coalesce(F.concat(F.lit("="), column), F.lit(""))
    raise ValueError(f"clicks cannot be ordered by a column of type {kind.simpleString()}")


def keyed_clicks(log: DataFrame, ties: tuple[str, ...]) -> DataFrame:
    """KEY, the order of the click, and the click itself as text. A row with both kinds of assessment is two clicks."""
    order = F.concat_ws("\x1f", *[sortable(F.col(c), log.schema[c].dataType) for c in ("timestamp", *ties)])
    retrieval = F.col("retrieval_assessment")
    chunk = F.concat_ws("#", F.lit("chunk"), F.coalesce(retrieval["position"].cast("string"), F.lit("-")), F.coalesce(
        F.concat(F.lit("="), retrieval["step_id"]), F.lit("")))
    places = F.filter(F.array(
        F.when(F.col("text_assessment").isNotNull(), F.lit("text")), F.when(retrieval.isNotNull(), chunk)), lambda p: p.isNotNull())
    reviewer = F.col("source.id")
    return log.select(
        F.coalesce("request_id", F.lit("")).alias("request_id"), F.coalesce(reviewer, F.lit("")).alias("reviewer"),
        reviewer.isNull().alias("anonymous"), F.explode(places).alias("place"), order.alias("order"),
        F.to_json(F.struct(*log.columns), JSON).alias("click"))


class NewestClicks(StatefulProcessor):
    """Lets a click pass that is newer than all before it at its place."""

    def __init__(self, kept_ms: int) -> None:
        self.kept_ms = kept_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", "orders string", self.kept_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        state = self.newest.get()
        orders, clicks = json.loads(state[0]) if state is not None else {}, {}
        for row in rows:  # any number of rows, one click a place is kept
            if row.place not in orders or row.order > orders[row.place]:
                orders[row.place], clicks[row.place] = row.order, row.click
        if clicks:
            self.newest.update((json.dumps(orders),))
            for click in clicks.values():
                yield Row(click=click)

    def close(self) -> None:
        pass


def stream_newest_clicks(stream: DataFrame, folder: str, ties: tuple[str, ...], kept_ms: int = KEPT_MS) -> StreamingQuery:
    """Follow a stream of clicks; only those that are newest at their key when they come reach the log in ``folder``."""
    spark, schema = stream.sparkSession, stream.schema
    newest = keyed_clicks(stream, ties).groupBy(*STATE_KEY).transformWithState(
        NewestClicks(kept_ms), "click string", "Update", "ProcessingTime")

    def handle(batch: DataFrame, batch_id: int) -> None:
        clicks = batch.select(F.from_json("click", schema, JSON).alias("c")).select("c.*")
        write_batch(reduce_feedback(clicks, ties), f"{folder}/clicks", batch_id)

    earlier = {name: spark.conf.get(name, None) for name in STREAM_CONF}
    for name, value in STREAM_CONF.items():
        spark.conf.set(name, value)
    try:  # a query keeps the settings that it is started with
        return (
            newest.writeStream.foreachBatch(handle).outputMode("update")
            .option("checkpointLocation", f"{folder}/progress")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in earlier.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
