"""Continuous jobs: ingest of payload files, bounded dedupe, throttling, leak counts."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from loamline.operators import otlp
from loamline.sources import store
from loamline.sources.shared import written

col = F.col


def payload_stream(spark: SparkSession, root: str) -> DataFrame:
    """Payload lines of an archive folder as they arrive."""
    rows = spark.readStream.schema("value string, signal string, dt date").text(root)
    return rows.select("signal", "dt", F.from_json("value", "payload_id string, json string").alias("v")).select("signal", "dt", "v.payload_id", "v.json")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in a checkpoint: a new checkpoint, even in the same place, is a new stream."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def continuous_ingest(stream: DataFrame, sink: str, checkpoint: str, denied: list[str], content: list[str], *, horizon_days: int = 7) -> StreamingQuery:
    """Redact, drop payloads that were stored before, decode both signals and store each micro-batch by one commit.

    A batch that runs twice finds its number in the manifests and adds nothing; one that died left nothing that is visible.
    """

    def keep(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        store.ingest(spark, sink, batch, denied, content, horizon_days=horizon_days, batch=(stream_id(spark, checkpoint), number))

    return stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dedupe(stream: DataFrame, time: str, *, horizon: str = "7 days") -> DataFrame:
    """First arrivals of each payload hash within a horizon; state older than that is dropped."""
    return stream.withColumn("batch_hash", otlp.batch_hash(col("json"))).withWatermark(time, horizon).dropDuplicatesWithinWatermark(["batch_hash"])


def observed_leaks(stream: DataFrame, signal: str, denied: list[str], content: list[str], name: str = "gate") -> DataFrame:
    """The redacted stream; each micro-batch's count of content values is observed under ``name``."""
    return otlp.redact(stream, signal, denied, content).observe(name, F.sum("gate_leaks").alias("leaks"), F.count("*").alias("payloads"))


class Tally(StreamingQueryListener):
    """Adds up what the micro-batches of one run of a stream observe under a name, however many there are; Spark itself remembers the last ones only."""

    def __init__(self, name: str) -> None:
        self.name, self.sums, self._ended = name, {}, {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        seen = event.progress.observedMetrics.get(self.name)
        if seen is None:
            return
        with self._lock:
            mine = self.sums.setdefault(str(event.progress.runId), {})
            for k, v in seen.asDict().items():
                mine[k] = mine.get(k, 0) + (v or 0)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()

    def _end(self, run: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run, threading.Event())

    def of(self, query: StreamingQuery, *, patience: float = 60) -> dict[str, int]:
        """The sums of a run that has ended; events come after one another, so the last batch's is in once the end is."""
        run = str(query.runId)
        if not self._end(run).wait(patience):
            raise TimeoutError("the stream's end was not reported")
        return dict(self.sums.get(run, {}))


def tallied(spark: SparkSession, start: Callable[[], StreamingQuery], name: str = "gate") -> dict[str, int]:
    """Run a stream over all that has arrived and return the sums of what its batches observed; empty if there was no batch."""
    tally = Tally(name)
    spark.streams.addListener(tally)
    try:
        query = start()
        query.awaitTermination()
        return tally.of(query)
    finally:
        spark.streams.removeListener(tally)


class Throttle(StatefulProcessor):
    """Keeps the time of the last accepted row of a key until the watermark is one gap behind it, from when on it says nothing.

    Most keys have a few rows, so what a call costs decides: rows come and go as rows, since a frame for each key takes many times as long.
    """

    def __init__(self, gap_us: int) -> None:
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us long")

    def _free_ms(self, last: int) -> int:
        return max(1, -(-(last + self.gap_us) // 1000))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        times = np.fromiter((r.us for r in rows), np.int64)
        times.sort()
        known = self.last.get()  # one question to the store: None is no state
        last, at, some = known[0] if known else None, 0, False
        while True:  # from one accepted row straight to the next
            if last is not None:
                at = int(np.searchsorted(times, last + self.gap_us))
            if at >= len(times):
                break
            last, some = int(times[at]), True
            yield Row(key=key[0], us=last)
        if some:
            self.last.update((last,))
            if not known:  # one timer a key: where the state moved on meanwhile, it is set anew when it rings
                self.handle.registerTimer(self._free_ms(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        known = self.last.get()
        if known:
            free = self._free_ms(known[0])
            if free <= timerValues.getCurrentWatermarkInMs():
                self.last.clear()
            else:
                self.handle.registerTimer(free)
        return iter([])

    def close(self) -> None:
        pass


def throttle_stream(stream: DataFrame, *, gap_us: int = 300_000_000, late: str = "1 hour") -> DataFrame:
    """Of (key, us) rows those at least ``gap_us`` after the last accepted one of their key.

    Keyed state lives in RocksDB and goes once the watermark, ``late`` behind the newest row, has passed the last accepted row by a
    gap: no row that may still arrive needs it, so the state holds the keys of the last gap only. Rows at the watermark or behind it are
    dropped (times up to 1970 once it has moved at all), as are rows without a time; a row before the last accepted one of its key is
    not accepted; a NULL key is a key.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    timed = stream.where("us IS NOT NULL").select("key", "us", F.timestamp_micros(F.greatest("us", F.lit(1))).alias("at")).withWatermark("at", late)
    kind = stream.schema["key"].dataType.simpleString()
    return timed.groupBy("key").transformWithState(Throttle(gap_us), f"key {kind}, us long", "append", "EventTime")


def _same(column: pa.Array, value: pa.Scalar) -> pa.Array:
    return pc.fill_null(pc.equal(column, value), False) if value.is_valid else pc.is_null(column)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows sorted by ``keys`` as tables of whole groups; only the last group of a batch waits for the next."""
    held: list[pa.RecordBatch] = []  # of one group
    for batch in batches:
        if not batch.num_rows:
            continue
        other = np.zeros(batch.num_rows, bool)
        for k in keys:
            other |= ~_same(batch[k], batch[k][-1]).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif held and not all(_same(held[-1][k].slice(0, 1), batch[k][-1])[0].as_py() for k in keys):
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _by_block(t: pa.Table) -> Iterator[tuple[int, list[int]]]:
    """(first row, times) of each (key, block) of a sorted table."""
    us, mark = t["us"].to_pylist(), list(zip(t["key"].to_pylist(), t["block"].to_pylist(), strict=True))
    at = 0
    for end in range(1, len(us) + 1):
        if end == len(us) or mark[end] != mark[at]:
            yield at, us[at:end]
            at = end


def throttle_batch(rows: DataFrame, key: str, time: str, *, gap_us: int = 300_000_000, block_us: int = 0) -> DataFrame:
    """The same over a whole table, (key, us), without gathering a key's times in one place.

    Time is cut into blocks (``block_us``, 256 gaps if not given). What a block needs of all before it is the earliest time that
    may be accepted, which lies within one gap of its start or before. So (1) every block tells, for each of its first times up to one
    gap in, which of its times would be the last accepted; (2) a fold over these few rows of a key finds where each block
    begins; (3) blocks list their accepted times. Rows without a time are left out; a NULL key is a key.
    """
    size = block_us or 256 * gap_us
    t = rows.select(F.col(key).alias("key"), F.unix_micros(time).alias("us")).where("us IS NOT NULL").distinct()
    t = t.withColumn("block", F.floor(F.col("us") / size).cast("bigint"))
    t = written(t.repartition("key", "block").sortWithinPartitions("key", "block", "us"), "times")
    dealt = lambda df: df.repartition("key", "block").sortWithinPartitions("key", "block", "us")
    key_type = t.schema["key"].dataType.simpleString()

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _groups(batches, ["key", "block"]):
            keys, blocks, out = whole["key"].to_pylist(), whole["block"].to_pylist(), {"key": [], "block": [], "us": [], "last": []}
            for at, us in _by_block(whole):
                last, to = us[:], len(us)
                for i in range(len(us) - 1, -1, -1):  # the last accepted time if this one is accepted
                    while to > i + 1 and us[to - 1] >= us[i] + gap_us:
                        to -= 1
                    last[i] = last[to] if to < len(us) else us[i]
                first_free = blocks[at] * size + gap_us
                few = next((i + 1 for i, x in enumerate(us) if x >= first_free), len(us))
                out["key"] += [keys[at]] * few
                out["block"] += [blocks[at]] * few
                out["us"] += us[:few]
                out["last"] += last[:few]
            yield from pa.Table.from_pydict({"key": pa.array(out["key"], whole.schema.field("key").type), **{k: pa.array(out[k], pa.int64()) for k in ("block", "us", "last")}}).to_batches()

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, free, done = object(), 0, None
        for batch in batches:
            out = {"key": [], "block": [], "us": []}
            for k, block, us, last in zip(*(batch[c].to_pylist() for c in ("key", "block", "us", "last")), strict=True):
                if k != now:
                    now, free, done = k, us, None
                if block != done and us >= free:
                    out["key"].append(k), out["block"].append(block), out["us"].append(us)
                    free, done = last + gap_us, block
            yield pa.RecordBatch.from_pydict({"key": pa.array(out["key"], batch.schema.field("key").type), "block": pa.array(out["block"], pa.int64()), "us": pa.array(out["us"], pa.int64())})

    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _groups(batches, ["key", "block"]):
            keys, starts, out = whole["key"].to_pylist(), whole["start"].to_pylist(), {"key": [], "us": []}
            for at, us in _by_block(whole):
                free = starts[at]
                for x in us:
                    if x >= free:
                        out["key"].append(keys[at]), out["us"].append(x)
                        free = x + gap_us
            yield from pa.Table.from_pydict({"key": pa.array(out["key"], whole.schema.field("key").type), "us": pa.array(out["us"], pa.int64())}).to_batches()

    told = dealt(t).mapInArrow(entries, f"key {key_type}, block bigint, us bigint, last bigint")
    starts = told.repartition("key").sortWithinPartitions("key", "block", "us").mapInArrow(begin, f"key {key_type}, block bigint, us bigint")
    starts = starts.select(F.col("key").alias("_k"), F.col("block").alias("_b"), F.col("us").alias("start"))
    inside = t.join(starts, F.col("key").eqNullSafe(F.col("_k")) & (F.col("block") == F.col("_b"))).select("key", "block", "us", "start")
    return dealt(inside).mapInArrow(accepted, f"key {key_type}, us bigint")


def run_available(start: Callable[[], StreamingQuery], then: Callable[[], DataFrame]) -> DataFrame:
    """Process all that has arrived, then refresh; an outside scheduler calls this hourly."""
    start().awaitTermination()
    return then()
