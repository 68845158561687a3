"""Operators over ordered rows of a key. Those that carry state beyond what a window function can express fold over
sorted partitions as a stream: rows of a key pass through one task in order, but are never collected."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.functions.nearhash import NearHashes
from attesta.functions.vectors import dot


def fold(df: DataFrame, keys: list[str], order: list[str], step: Callable[[object, pd.DataFrame], tuple[object, pd.Series]], out: str, out_type: str) -> DataFrame:
    """Add a column computed by folding over the rows of each key in order.

    step gets the state (None at the start of a key) and a stretch of the key's rows, and returns the new state and the
    column's values for the stretch. A key may come in several stretches.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out}` {out_type}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, state = None, None
        for batch in batches:
            if not len(batch):
                continue
            ids = batch[keys].ne(batch[keys].shift()).any(axis=1).to_numpy()
            ids[0] = True
            parts = []
            for part in np.split(np.arange(len(batch)), np.flatnonzero(ids)[1:]):
                rows = batch.iloc[part]
                key = tuple(rows[keys].iloc[0])
                if key != held:
                    held, state = key, None
                state, values = step(state, rows)
                parts.append(np.asarray(values))
            yield batch.assign(**{out: np.concatenate(parts)})

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def resetting_windows(df: DataFrame, keys: list[str], order: list[str], amount: str, limit: float) -> DataFrame:
    """window_no: rows are gathered until their amounts reach limit; the row that reaches it is the last of its window."""

    def step(state, rows):
        total, number = state or (0, 0)
        out = np.empty(len(rows), np.int64)
        for i, x in enumerate(rows[amount].to_numpy().tolist()):
            out[i] = number
            total += x
            if total >= limit:
                total, number = 0, number + 1
        return (total, number), out

    return fold(df, keys, order, step, "window_no", "bigint")


def with_lag_similarity(df: DataFrame, keys: list[str], order: list[str], vector: str) -> DataFrame:
    """similarity: cosine with the row before (null at the first row)."""
    before = F.lag(vector).over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("similarity", F.when(before.isNotNull(), dot(F.col(vector), before)))


def boundaries(df: DataFrame, keys: list[str], order: list[str], threshold: float = 0.55) -> DataFrame:
    """piece: a new one begins where similarity falls below threshold."""
    run = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("piece", F.sum(F.when(F.col("similarity") < threshold, 1).otherwise(0)).over(run))


def merge_small(pieces: DataFrame, keys: list[str], min_words: int = 200) -> DataFrame:
    """group_no: a piece (keys, piece, words) of fewer than min_words words joins the one before; the first always stands."""
    by = Window.partitionBy(*keys).orderBy("piece")
    first = F.row_number().over(by) == 1
    stands = F.when(first | (F.col("words") >= min_words), 1).otherwise(0)
    return pieces.withColumn("_s", stands).withColumn("group_no", F.sum("_s").over(by.rowsBetween(Window.unboundedPreceding, 0)) - 1).drop("_s")


def sequence_id(prefix: Column, number: Column, digits: int = 3, mark: str = "_") -> Column:
    return F.format_string(f"%s{mark}%0{digits}d", prefix.cast("string"), number.cast("bigint"))


#: Frames that are judged between two look-ups in the index.
STRETCH = 1024


class KeptFrames:
    """What a greedy choice of frames remembers of a key: the time of the last kept frame and an index of the kept hashes."""

    def __init__(self, min_density: float, min_gap: float, max_distance: int, last: float | None = None, kept: np.ndarray | None = None) -> None:
        self.min_density, self.min_gap, self.max_distance, self.last = min_density, min_gap, max_distance, last
        self.index = NearHashes(max_distance)
        if kept is not None:
            self.index.add(kept.astype(np.int64).view(np.uint64))

    def judge(self, times: np.ndarray, densities: np.ndarray, bits: np.ndarray) -> tuple[list[str], list[int]]:
        """Verdicts of frames in order of time, and the hashes newly kept."""
        out, added = [], []
        hashes = bits.astype(np.int64).view(np.uint64)
        for at in range(0, len(hashes), STRETCH):
            part = slice(at, at + STRETCH)
            seen = self.index.near(hashes[part])  # like one kept before this stretch
            new = np.empty(STRETCH, np.uint64)
            n = 0
            for t, d, b, old in zip(times[part].tolist(), densities[part].tolist(), hashes[part], seen):
                if d < self.min_density:
                    out.append("density")
                elif self.last is not None and t - self.last < self.min_gap:
                    out.append("spacing")
                elif old or (np.bitwise_count(new[:n] ^ b) <= self.max_distance).any():
                    out.append("hamming")
                else:
                    out.append("kept")
                    self.last, new[n] = t, b
                    n += 1
            self.index.add(new[:n])
            added += new[:n].view(np.int64).tolist()
        return out, added


def greedy_frames(df: DataFrame, keys: list[str], order: list[str], ts: str, density: str, bits: str, min_density: float = 0.04, min_gap: float = 2.0, max_distance: int = 6) -> DataFrame:
    """verdict of every frame in order of time: density, spacing (too soon after the last kept one), hamming (too like any kept one) or kept.

    Kept hashes are indexed by blocks of their bits, so a frame is compared with those only that agree with it in two of
    them. `streaming.stateful.frames` is the form for streams.
    """

    def step(state, rows):
        state = state or KeptFrames(min_density, min_gap, max_distance)
        verdicts, _ = state.judge(rows[ts].to_numpy(), rows[density].to_numpy(), rows[bits].to_numpy())
        return state, pd.Series(verdicts, dtype=object)

    return fold(df, keys, order, step, "verdict", "string")


def downsample(df: DataFrame, keys: list[str], order: list[str], cap: int = 400) -> DataFrame:
    """At most cap rows of each key, evenly spaced: row i of n stays if it is floor(k * n / cap) for some k."""
    by = Window.partitionBy(*keys)
    i = F.row_number().over(by.orderBy(*order)) - 1
    ranked = df.withColumn("_i", i).withColumn("_n", F.count("*").over(by))
    # the smallest k with floor(k * n / cap) >= i is ceil(i * cap / n)
    k = F.ceil(F.col("_i") * cap / F.col("_n"))
    stays = (F.col("_n") <= cap) | ((k < cap) & (F.floor(k * F.col("_n") / cap) == F.col("_i")))
    return ranked.where(stays).drop("_i", "_n")


def video_rank(videos: DataFrame) -> DataFrame:
    """rank from 0 by (upload_date, video_id), a missing date first. The manifest is one row per video: small."""
    return videos.withColumn("rank", F.row_number().over(Window.orderBy(F.coalesce("upload_date", F.lit("")), "video_id")) - 1)
