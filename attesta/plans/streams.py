"""Streams over events: the batch form of windows and sessions, and streams with state that are run, stopped and run again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.plans.registry import ORACLE, query
from attesta.sources.tables import new_path, staged
from attesta.streaming import events as E
from attesta.streaming import stateful as S


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, count(*) AS n_events, sum(value::DECIMAL(18,4))::DOUBLE AS total FROM events GROUP BY ALL")
def events_daily(read, spark):
    return _plain(E.tumbling(E.stamped(read("events")), "1 day"))


@query("""SELECT w::TIMESTAMP AS window_start, event_type, count(*) AS n_events, sum(value::DECIMAL(18,4))::DOUBLE AS total
    FROM (SELECT *, unnest([time_bucket(INTERVAL '12 hours', ts, TIMESTAMP '1970-01-01'), time_bucket(INTERVAL '12 hours', ts, TIMESTAMP '1970-01-01') - INTERVAL '12 hours']) AS w FROM events) GROUP BY ALL""")
def events_sliding(read, spark):
    return _plain(E.sliding(E.stamped(read("events")), "1 day", "12 hours"))


@query("""WITH g AS (SELECT *, coalesce(ts >= lag(ts) OVER w + INTERVAL '12 hours', true) AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(n::INT) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '12 hours' AS session_end, count(*) AS n_events FROM s GROUP BY user_id, k""")
def events_sessions(read, spark):
    out = E.sessions(E.stamped(read("events")))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query("SELECT DISTINCT user_id, event_type FROM events")
def events_distinct(read, spark):
    return E.distinct(read("events").select("user_id", "event_type"), ["user_id", "event_type"])


def _plain(df):
    return df.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn("total", F.col("total").cast("double"))


# --- streams with state: a run for each third of the time, each going on from the checkpoint of the one before

#: Thirds of the time that events take.
THIRDS_SQL = "(3 * (epoch_us(ts) - min(epoch_us(ts)) OVER ()) // (max(epoch_us(ts)) OVER () - min(epoch_us(ts)) OVER () + 1))"


def timed(read) -> DataFrame:
    return read("events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


def in_thirds(rows: DataFrame, by: str, step: Callable[[DataFrame, int], None], name: str) -> None:
    """Call step for the rows of each third of their time, from a table that is written once."""
    rows = staged(rows, name)
    low, high = rows.agg(F.min(by), F.max(by)).first()
    third = F.floor((F.col(by) - F.lit(low)) * 3 / F.lit((high or 0) - (low or 0) + 1))
    for n in range(3):
        step(rows.where(third == n), n)


def streamed(spark, rows: DataFrame, by: str, operator: Callable[[DataFrame], DataFrame], name: str, columns: str) -> DataFrame:
    """What the operator gives for a stream of the rows, which comes in three runs."""
    own, out, checkpoint = S.session(spark), new_path(spark, name + "-out"), new_path(spark, name + "-checkpoint")
    path = new_path(spark, name)

    def run(part: DataFrame, n: int) -> None:
        part.write.mode("append").parquet(path)
        E.run_available(operator(E.read(own, path, rows.schema)), out, checkpoint)

    in_thirds(rows, by, run, name + "-thirds")
    return spark.read.schema(columns).parquet(out)


@query(ORACLE["frame_dedup"])
def frames_streamed(read, spark):
    """The verdicts of frame_dedup from a stream whose state holds the kept hashes."""
    bits = F.conv(F.substring(F.sha2(F.col("event_id").cast("string"), 256), 1, 3), 16, 10).cast("bigint")
    rows = timed(read).select("user_id", "us", "event_id", F.col("value").alias("density"), bits.alias("bits"))
    greedy = lambda stream: S.frames(stream, "user_id", "event_id", "us", "density", "bits", 5.0, 3_600_000_000, 1)
    return streamed(spark, rows, "us", greedy, "frames", "user_id bigint, event_id bigint, verdict string")


@query(ORACLE["budget_admitted"])
def budget_guarded(read, spark):
    """The admissions of budget_admitted from a log that is replayed in three runs: no row is spent twice."""
    rows = timed(read).select("user_id", "us", "event_id", F.round(F.col("value") * 100).cast("bigint").alias("v"))
    guard = lambda stream: S.guard(stream, "user_id", "event_id", ["us", "event_id"], "v", 30000)
    return streamed(spark, rows, "us", guard, "guard", "event_id bigint, accepted boolean")


@query(ORACLE["segment_windows"])
def windows_streamed(read, spark):
    """The windows of segment_windows from events that come up to a day out of order; an event far ahead lets the last ones pass."""
    e = timed(read)
    rows = e.select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", F.round(F.col("value") * 100).cast("bigint").alias("amount"), (F.col("us") + F.col("event_id") % 2 * 86_400_000_000).alias("comes"))
    last = e.agg(F.timestamp_micros(F.max("us") + 30 * 86_400_000_000).alias("ts"), (F.max("us") + 2 * 86_400_000_000).alias("comes"))
    ahead = last.select(F.lit(-1).cast(dict(rows.dtypes)["user_id"]).alias("user_id"), "ts", F.lit(-1).cast(dict(rows.dtypes)["event_id"]).alias("event_id"), F.lit(0).cast("bigint").alias("amount"), "comes")
    gathered = lambda stream: S.windows(stream, "user_id", "event_id", "ts", "amount", 3000, "3 days")
    return streamed(spark, rows.unionByName(ahead), "comes", gathered, "windows", "user_id bigint, event_id bigint, window_no bigint")


@query("SELECT user_id, event_type, arg_min(event_id, struct_pack(t := ts, e := event_id)) AS event_id FROM events GROUP BY ALL")
def loaded_once(read, spark):
    """The first event of each user and type, loaded batch by batch as insert-or-ignore; the last batch is loaded twice."""
    rows = timed(read).select("user_id", "event_type", "event_id", "us")
    table, checkpoint, path = new_path(spark, "loaded"), new_path(spark, "loaded-checkpoint"), new_path(spark, "loaded-in")
    write = S.only_new(["user_id", "event_type"], ["us", "event_id"])

    def run(part: DataFrame, n: int) -> None:
        part.write.mode("append").parquet(path)
        S.load(E.read(spark, path, rows.schema), table, checkpoint, write)
        if n == 2:
            write(part, table, n)

    in_thirds(rows, "us", run, "loaded-thirds")
    return spark.read.schema(rows.schema).parquet(table).select("user_id", "event_type", "event_id")


@query(f"WITH p AS (SELECT user_id, event_type, {THIRDS_SQL} AS third FROM events), c AS (SELECT user_id, event_type, third, count(*) AS n_events FROM p GROUP BY ALL) SELECT user_id, event_type, arg_max(n_events, third) AS n_events FROM c GROUP BY ALL")
def loaded_newest(read, spark):
    """The number of events of each user and type in the last third that has any, loaded as insert-or-replace; every batch is loaded twice."""
    rows = timed(read).select("user_id", "event_type", "us")
    table, keys = new_path(spark, "newest"), ["user_id", "event_type"]

    def run(part: DataFrame, n: int) -> None:
        for _ in range(2):
            S.all_versions(part.groupBy(*keys).agg(F.count("*").alias("n_events")), table, n)

    in_thirds(rows, "us", run, "newest-thirds")
    return S.newest(spark, table, "user_id bigint, event_type string, n_events bigint", keys)
