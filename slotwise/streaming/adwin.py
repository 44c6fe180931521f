"""Online drift: one adaptive-window detector per (entity, feature).

The detector is sequential by nature, so the parallelism is over keys. Neither form holds
a series in memory: the batch form walks sorted Arrow batches, the streaming form keeps
the detector's O(log n) buckets as state.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from slotwise.streaming.live import batch_folder, run_available

DELTA = 0.002
# Fixed values of the detector: values between tests, buckets per size, shortest side, grace.
CLOCK, BUCKETS, MIN_SIDE, GRACE = 32, 5, 5, 10

OUT_SCHEMA = (
    "household_id string, feature string, timestamp timestamp_ntz, kind string,"
    " n_updates bigint, width bigint, delta double"
)
STATE_SCHEMA = (
    "state_delta double, updates bigint, ticks bigint, count bigint, total double, spread double,"
    " sizes array<bigint>, sums array<double>, spreads array<double>"
)


class Adwin:
    """Window of buckets whose sizes double with age; old buckets go when means differ."""

    def __init__(self, delta: float = DELTA):
        self.updates = 0
        self.restart(delta)

    def restart(self, delta: float) -> None:
        self.delta = delta
        self.ticks = self.width = 0
        self.total = self.spread = 0.0
        # Oldest first: [size, sum, sum of squared deviations from the bucket mean].
        self.buckets: list[list[float]] = []

    def add(self, x: float) -> bool:
        self.updates += 1
        self.ticks += 1
        if self.width:
            self.spread += (x - self.total / self.width) ** 2 * self.width / (self.width + 1)
        self.width += 1
        self.total += x
        self.buckets.append([1, x, 0.0])
        self._merge()
        if self.ticks % CLOCK or self.width <= GRACE:
            return False
        return self._cut()

    def _merge(self) -> None:
        size, end = 1, len(self.buckets)
        while True:
            start = end
            while start and self.buckets[start - 1][0] == size:
                start -= 1
            if end - start <= BUCKETS:
                return
            (n, s, q), (m, t, r) = self.buckets[start], self.buckets[start + 1]
            gap = s / n - t / m
            self.buckets[start: start + 2] = [[n + m, s + t, q + r + gap * gap * n * m / (n + m)]]
            size, end = size * 2, start + 1

    def _differs(self, n: float, s: float) -> bool:
        m = self.width - n
        gap = abs(s / n - (self.total - s) / m)
        confidence = math.log(2 * math.log(self.width) / self.delta)
        harmonic = 1 / (n - MIN_SIDE + 1) + 1 / (m - MIN_SIDE + 1)
        variance = max(self.spread, 0.0) / self.width
        return gap > math.sqrt(2 * harmonic * variance * confidence) + 2 / 3 * confidence * harmonic

    def _cut(self) -> bool:
        found = False
        while self._some_split_differs():
            found = True
            n, s, q = self.buckets.pop(0)
            rest = self.width - n
            gap = s / n - (self.total - s) / rest
            self.spread -= q + gap * gap * n * rest / self.width
            self.width, self.total = rest, self.total - s
        return found

    def _some_split_differs(self) -> bool:
        n = s = 0.0
        for size, part, _ in self.buckets:
            n, s = n + size, s + part
            if self.width - n < MIN_SIDE:
                return False
            if n >= MIN_SIDE and self._differs(n, s):
                return True
        return False

    def pack(self) -> tuple:
        sizes, sums, spreads = (list(c) for c in zip(*self.buckets)) if self.buckets else ([], [], [])
        return (
            self.delta, self.updates, self.ticks, int(self.width), self.total, self.spread,
            [int(n) for n in sizes], sums, spreads,
        )

    @classmethod
    def unpack(cls, state: Sequence) -> Adwin:
        out = cls(state[0])
        _, out.updates, out.ticks, out.width, out.total, out.spread, sizes, sums, spreads = state
        out.buckets = [list(b) for b in zip(sizes, sums, spreads)]
        return out


def detector_input(readings: DataFrame, features: Sequence[str], order: str = "seq") -> DataFrame:
    """(household_id, feature, timestamp, seq, op, value) rows; null values are left out."""
    long = readings.unpivot(["household_id", "timestamp", order], list(features), "feature", "value")
    known = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.select("household_id", "feature", "timestamp", F.col(order).alias("seq"), F.lit("value").alias("op"), "value")


def control_rows(commands: DataFrame, features: Sequence[str]) -> DataFrame:
    """Commands ``reset`` and ``delta`` as input rows; without a feature they go to all.

    ``commands`` has household_id, timestamp, seq, op, feature and value (the new delta).
    """
    targets = F.when(F.col("feature").isNull(), F.array(*[F.lit(f) for f in features])).otherwise(F.array("feature"))
    return commands.select(
        "household_id", F.explode(targets).alias("feature"), "timestamp", "seq", "op", F.col("value").cast("double").alias("value")
    )


def _apply(detector: Adwin, op: str, value: float) -> bool:
    if op == "reset":
        detector.restart(detector.delta)
    elif op == "delta":
        detector.restart(value)
    else:
        return detector.add(value)
    return False


_OUT = ["household_id", "feature", "timestamp", "kind", "n_updates", "width", "delta"]
_STATE_COLUMNS = STATE_SCHEMA.split(", ")
_STATE = [c.split(" ")[0] for c in _STATE_COLUMNS]
_KEYS = ["household_id", "feature"]


def _walk(rows: DataFrame, delta: float) -> DataFrame:
    """Drift rows in event-time order and a closing state row with the detector per key.

    Rows of op ``state`` carry a saved detector and come first. A key is walked in one
    task, as its detector demands, but in batches of sorted rows.
    """

    def close(key, last, d: Adwin) -> tuple:
        return (*key, last, "state", d.updates, d.width, d.delta, *d.pack())

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, detector, last = None, None, None
        for frame in frames:
            out = []
            columns = (frame[c] for c in ("household_id", "feature", "timestamp", "op", "value"))
            for i, (entity, feature, ts, op, value) in enumerate(zip(*columns)):
                if (entity, feature) != key:
                    if key is not None:
                        out.append(close(key, last, detector))
                    key, detector = (entity, feature), Adwin(delta)
                last = ts
                if op == "state":
                    detector = Adwin.unpack([frame[c].iloc[i] for c in _STATE])
                elif _apply(detector, op, value):
                    out.append((*key, ts, "drift", detector.updates, detector.width, detector.delta, *[None] * len(_STATE)))
            yield pd.DataFrame(out, columns=_OUT + _STATE)
        if key is not None:
            yield pd.DataFrame([close(key, last, detector)], columns=_OUT + _STATE)

    placed = rows.repartition(*_KEYS).sortWithinPartitions(*_KEYS, F.col("op") != "state", "timestamp", "seq")
    return placed.mapInPandas(walk, f"{OUT_SCHEMA}, {STATE_SCHEMA}")


def batch_events(rows: DataFrame, delta: float = DELTA) -> DataFrame:
    """Drift rows and one closing state row per key of a whole table."""
    return _walk(rows, delta).select(*_OUT)


def backfill_events(rows: DataFrame, path: str, delta: float = DELTA) -> DataFrame:
    """The same over a stream whose micro-batches may be large.

    Each micro-batch is sorted and walked after the detectors saved by the previous one,
    and writes the detectors of all keys for the next. Memory per task stays that of one
    Arrow batch, whatever share of a micro-batch one key has.
    """
    run_available(rows, detector_batches(rows.sparkSession, path, delta), f"{path}/checkpoint")
    return rows.sparkSession.read.parquet(f"{path}/out").select(*_OUT)


def detector_batches(spark: SparkSession, path: str, delta: float = DELTA) -> Callable[[DataFrame, int], None]:
    """Handler that walks a batch of input rows after the detectors saved by the batch before, and saves all of them again."""
    write = batch_folder(f"{path}/out")

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch_id:
            saved = spark.read.parquet(f"{path}/out/batch_id={batch_id - 1}").filter("kind = 'state'")
            batch = batch.unionByName(saved.withColumn("op", F.lit("state")).drop("kind", "n_updates", "width", "delta"), True)
        else:
            empty = [F.lit(None).cast(c.split(" ")[1]).alias(c.split(" ")[0]) for c in _STATE_COLUMNS]
            batch = batch.select("*", *empty)
        write(_walk(batch, delta), batch_id)

    return handle


def stream_events(rows: DataFrame, delta: float = DELTA) -> DataFrame:
    """The same detectors over a stream; their state outlives the micro-batches.

    For live streams: the rows of a key in one micro-batch are put in event-time order in
    memory, so their number is what the source admits at once. Use ``backfill_events``
    for history.
    """

    def update(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        detector = Adwin.unpack(state.get) if state.exists else Adwin(delta)
        rows = pd.concat(list(frames)).sort_values(["timestamp", "seq"])
        out = [
            (*key, ts, "drift", detector.updates, detector.width, detector.delta)
            for ts, op, value in zip(rows["timestamp"], rows["op"], rows["value"])
            if _apply(detector, op, value)
        ]
        state.update(detector.pack())
        out.append((*key, rows["timestamp"].iloc[-1], "state", detector.updates, detector.width, detector.delta))
        yield pd.DataFrame(out, columns=_OUT)

    return rows.groupBy("household_id", "feature").applyInPandasWithState(
        update, OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout
    )


def drift_status(
    events: DataFrame, n_updates: DataFrame, delta: float = DELTA, recent: int = 10, windows: DataFrame | None = None
) -> DataFrame:
    """One row: updates, drift events, features that ever drifted, the last events and, from
    ``windows`` (feature, width: see ``detector_windows``), the widest window of each feature.

    The features are the monitored ones, a short fixed list, and the recent events are a
    top-n, so nothing in this row grows with the data.
    """
    ordered = events.orderBy(F.desc("timestamp"), "feature").limit(recent)
    stamp = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    tail = ordered.agg(F.sort_array(F.collect_list(F.struct(stamp.alias("timestamp"), "feature")))).scalar()
    status = events.agg(
        F.count(F.lit(1)).alias("n_drift_events_total"),
        F.array_sort(F.collect_set("feature")).alias("features_with_drift_ever"),
    ).select(
        n_updates.scalar().alias("n_updates"), "*", tail.alias("recent_events"), F.lit(delta).alias("delta")
    )
    if windows is None:
        return status
    widest = windows.groupBy("feature").agg(F.max("width").alias("width"))
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("feature", "width"))))
    return status.withColumn("window_widths", widest.agg(entries).scalar())


def detector_windows(output: DataFrame) -> DataFrame:
    """Current window width per key from the latest state row."""
    state = output.filter("kind = 'state'")
    return state.groupBy("household_id", "feature").agg(
        F.max_by("width", "n_updates").alias("width"), F.max("n_updates").alias("n_updates"),
        F.max_by("delta", "n_updates").alias("delta"),
    )
