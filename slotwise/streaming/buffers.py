"""The last readings of each entity as keyed list state.

``live.buffer_stream`` writes candidates per batch and leaves the choice to the reader; here the state itself is the buffer, so
what is kept grows with the entities and not with the stream, and entities that fall silent can expire.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from slotwise import config as C
from slotwise.config import DEFAULT, SeriesConfig
from slotwise.streaming.live import batch_folder, run_available

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "household_id string, timestamp timestamp, seq bigint, value double, kind string"


class RecentReadings(StatefulProcessor):
    """A list of at most ``n`` readings per key, oldest first; a key without a reading for ``idle_minutes`` of event time is dropped."""

    def __init__(self, n: int, idle_minutes: int | None):
        self.n, self.idle_ms = n, None if idle_minutes is None else idle_minutes * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", "timestamp timestamp, seq bigint, value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.recent.get()] if self.recent.exists() else []
        for frame in rows:
            value = frame["value"].astype(object).where(frame["value"].notna(), None)
            held += zip(frame["timestamp"].dt.to_pydatetime(), frame["seq"].astype(int).tolist(), value, strict=True)
            held = sorted(held, key=lambda r: r[:2])[-self.n:]
        self.recent.put(held)
        if self.idle_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int(pd.Timestamp(held[-1][0]).timestamp() * 1000) + self.idle_ms)
        out = pd.DataFrame(held, columns=["timestamp", "seq", "value"])
        out.insert(0, "household_id", key[0])
        yield out.assign(value=out["value"].astype(float), kind="reading")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.recent.clear()
        at = pd.Timestamp(expiredTimerInfo.getExpiryTimeInMs(), unit="ms")
        yield pd.DataFrame({"household_id": [key[0]], "timestamp": [at], "seq": [-1], "value": [float("nan")], "kind": ["expired"]})

    def close(self) -> None:
        pass


def state_buffer(
    stream: DataFrame, path: str, cfg: SeriesConfig = DEFAULT, n: int = C.RECENT_BUFFER_ROWS, order: str = "seq",
    idle_minutes: int | None = None, lateness_minutes: int = 60,
) -> DataFrame:
    """The last ``n`` readings per entity after all batches so far; equals ``live.recent_buffer`` unless entities expire.

    A run continues with the state of the one before in ``path``. With ``idle_minutes`` an entity is forgotten once the watermark is so far past
    its last reading; one that comes back starts anew. Needs the RocksDB state store.
    """
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER)
    rows = stream.select(cfg.entity, F.col(cfg.time).cast("timestamp").alias("timestamp"), F.col(order).cast("bigint").alias("seq"), F.col(cfg.value).cast("double").alias("value"))
    timed = idle_minutes is not None
    if timed:
        rows = rows.withWatermark("timestamp", f"{lateness_minutes} minutes")
    buffers = rows.groupBy(cfg.entity).transformWithStateInPandas(RecentReadings(n, idle_minutes), OUT, "Update", "EventTime" if timed else "None")
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        run_available(buffers, batch_folder(f"{path}/out"), f"{path}/checkpoint", "update")
    finally:
        spark.conf.set(PROVIDER, before)
    out = spark.read.parquet(f"{path}/out")
    # An entity's rows of its last batch are its buffer; an expiry comes after the rows of its batch.
    last = out.groupBy("household_id").agg(F.max("batch_id").alias("_b"))
    newest = out.join(last, (out["batch_id"] == last["_b"]) & (out["household_id"] == last["household_id"]), "left_semi").filter("kind = 'reading'")
    return newest.select(
        F.col("seq").alias(order), F.col("household_id").alias(cfg.entity), F.col("timestamp").cast("timestamp_ntz").alias(cfg.time),
        F.when(~F.isnan("value"), F.col("value")).alias(cfg.value),
    )
