"""Operators over streams that keep state by key. The state lives in the checkpoint: a run that was stopped goes on from there.

All need the RocksDB state store; `session` gives a session that has it. What a run has taken in is never read again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

from attesta.operators.sequence import KeptFrames

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of the same application for streams with state. The number of state partitions is fixed by a checkpoint's first run."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    return own


def _sorted(batches: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """A key's rows of one batch, which the size of batches bounds, in order."""
    return pd.concat(list(batches)).sort_values(order, kind="stable", ignore_index=True)


def _schema(df: DataFrame, columns: list[str], more: str) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{c}` {kinds[c]}" for c in columns) + ", " + more


def frames(stream: DataFrame, key: str, frame: str, ts: str, density: str, bits: str, min_density: float = 0.04, min_gap: float = 2.0, max_distance: int = 6) -> DataFrame:
    """key, frame, verdict: `operators.sequence.greedy_frames` for frames that arrive in order of time, batch by batch.

    State of a key: the hashes kept so far, as a list that only grows at its end, and the time of the last kept frame
    (a number). Within a batch rows are put in order of time and frame; a batch does not go back behind an earlier one.
    """
    hidden = {"t": dict(stream.dtypes)[ts]}

    class Greedy(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.kept = handle.getListState("kept", "bits bigint")
            self.last = handle.getValueState("last", f"t {hidden['t']}")

        def handleInputRows(self, k, rows, timerValues):
            own = _sorted(rows, [ts, frame])
            kept = np.array([h[0] for h in self.kept.get()], np.int64) if self.kept.exists() else None
            state = KeptFrames(min_density, min_gap, max_distance, self.last.get()[0] if self.last.exists() else None, kept)
            verdicts, added = state.judge(own[ts].to_numpy(), own[density].to_numpy(), own[bits].to_numpy())
            if added:
                self.kept.appendList([(h,) for h in added])
                self.last.update((state.last,))
            yield pd.DataFrame({key: own[key], frame: own[frame], "verdict": verdicts})

        def close(self) -> None:
            pass

    return stream.groupBy(key).transformWithStateInPandas(Greedy(), _schema(stream, [key, frame], "verdict string"), "append", "None")


def guard(stream: DataFrame, key: str, row: str, order: list[str], amount: str, ceiling: int) -> DataFrame:
    """key, row, accepted, spent: `operators.budget.admit` for a log that arrives batch by batch, in whole units of money.

    State of a key: what it has spent. A row that does not fit spends nothing. Rows of a batch are taken in the given order.
    """

    class Guard(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.spent = handle.getValueState("spent", "v bigint")

        def handleInputRows(self, k, rows, timerValues):
            own = _sorted(rows, order)
            spent, out = self.spent.get()[0] if self.spent.exists() else 0, []
            for x in own[amount].tolist():
                fits = spent + x <= ceiling
                spent += x if fits else 0
                out.append((fits, spent))
            self.spent.update((spent,))
            yield pd.DataFrame({key: own[key], row: own[row], "accepted": [a for a, _ in out], "spent": [s for _, s in out]})

        def close(self) -> None:
            pass

    return stream.groupBy(key).transformWithStateInPandas(Guard(), _schema(stream, [key, row], "accepted boolean, spent bigint"), "append", "None")


def windows(stream: DataFrame, key: str, row: str, ts: str, amount: str, limit: int, delay: str) -> DataFrame:
    """key, row, window_no, closes: `operators.sequence.resetting_windows` for rows that arrive out of order by up to `delay`.

    ts is a timestamp. A row waits in the key's state until the watermark has passed it, when an event-time timer takes
    the rows that are due in order of ts and row; so a window is closed (its last row has closes) when nothing that
    belongs into it can come any more. A row that comes behind the watermark is late and left out.
    """
    kinds, columns = dict(stream.dtypes), [key, row, "window_no", "closes"]

    class Gathered(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.waiting = handle.getListState("waiting", f"row {kinds[row]}, us bigint, amount {kinds[amount]}")
            self.window = handle.getValueState("window", f"total {kinds[amount]}, number bigint")

        def handleInputRows(self, k, rows, timerValues):
            new = [r for b in rows for r in zip(b[row].tolist(), b["us_of_row"].tolist(), b[amount].tolist())]
            if not new:
                return iter([])
            before = min(self.handle.listTimers(), default=None)
            self.waiting.appendList(new)
            self._wake(min(r[1] for r in new), before)
            return iter([])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            passed = timerValues.getCurrentWatermarkInMs() * 1000
            all_ = list(self.waiting.get()) if self.waiting.exists() else []
            due = sorted((r for r in all_ if r[1] < passed), key=lambda r: (r[1], r[0]))
            later = [tuple(r) for r in all_ if r[1] >= passed]
            total, number = self.window.get() if self.window.exists() else (0, 0)
            out = []
            for i, _, x in due:
                total += x
                out.append((key[0], i, number, total >= limit))
                if total >= limit:
                    total, number = 0, number + 1
            if due:
                self.window.update((total, number))
                self.waiting.clear()
                if later:
                    self.waiting.put(later)
            if later:
                self._wake(min(r[1] for r in later), None)
            yield pd.DataFrame(out, columns=columns)

        def _wake(self, us: int, before: int | None) -> None:
            at = us // 1000 + 1  # the first millisecond after it
            if before is not None and before > at:
                self.handle.deleteTimer(before)
            if before is None or before > at:
                self.handle.registerTimer(at)

        def close(self) -> None:
            pass

    timed = stream.withColumn("us_of_row", F.unix_micros(ts)).withWatermark(ts, delay)
    return timed.groupBy(key).transformWithStateInPandas(Gathered(), _schema(stream, [key, row], "window_no bigint, closes boolean"), "append", "EventTime")


def load(stream: DataFrame, table: str, checkpoint: str, write: Callable[[DataFrame, str, int], None]) -> None:
    """Hand what is there to write(batch, table, batch id), batch by batch, and stop. After a failure the last batch comes again under its id."""
    stream.writeStream.foreachBatch(lambda batch, number: write(batch, table, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _earlier(spark: SparkSession, table: str, number: int, schema) -> DataFrame:
    """Rows of a table of batches that came before this one. The first batch has the number 0."""
    if number == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", table).parquet(table).where(F.col("_batch") < number)


def only_new(keys: list[str], order: list[str]) -> Callable[[DataFrame, str, int], None]:
    """Insert-or-ignore for `load`: of a batch, the rows whose key no earlier batch has; of equal keys in it the first by order.

    A batch owns the partition _batch=<id> of the table and replaces it as a whole, and looks at earlier ones only: if
    it comes again, the table is as it was.
    """

    def write(batch: DataFrame, table: str, number: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c not in keys]
        first = batch.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(batch.columns)
        old = _earlier(spark, table, number, StructType([*batch.schema.fields, StructField("_batch", LongType())])).select(*keys)
        first.join(old, keys, "left_anti").write.mode("overwrite").parquet(f"{table}/_batch={number}")

    return write


def all_versions(batch: DataFrame, table: str, number: int) -> None:
    """Insert-or-replace for `load`: every batch is kept in its own partition; `newest` reads the rows that count."""
    batch.write.mode("overwrite").parquet(f"{table}/_batch={number}")


def newest(spark: SparkSession, table: str, schema: str, keys: list[str]) -> DataFrame:
    """Of rows with equal keys (nulls are equal) that of the last batch; one batch has a key once."""
    rows = spark.read.schema(schema + ", _batch bigint").option("basePath", table).parquet(table)
    rest = [c for c in rows.columns if c not in (*keys, "_batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])
