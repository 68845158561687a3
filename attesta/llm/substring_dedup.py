"""Passages that repeat across documents, fuzzy ones included, by collinear chaining of shared k-mer seeds.

1. Seeds: word k-mers with a small hash, a fixed share of all, whatever stands around them; and minimizers, so any
   stretch of `window + k - 1` equal words shares one.
2. Join: each seed is linked to its earliest holder (the smallest document id that has it), found by an aggregation
   that combines before the shuffle. So a seed that thousands of documents share makes thousands of links, not millions.
   An earliest holder may have no more than a fragment of a passage. Where the seeds of a span point to several places,
   the spans of seeds, hashed, are seeds themselves: what shares such a hash holds the whole span.
3. Chain: for each pair (document, earlier document), the matches are chained in order of both positions; a Fenwick
   tree gives the best predecessor of each match in logarithmic time, with a cost for the gap.
4. Align: each chain is extended word by word over the two texts, the gaps between its seeds are aligned, and passages
   of enough words and identity remain. A chain whose extension comes to the end of the text that was cut out for it is
   aligned again with more text, until it ends within.
5. Exact passages: what a reported passage does not cover is compared by whole windows of min_words words, so no equal
   stretch of that length is lost, whoever holds its seeds. Windows that share their smallest long k-mer, the anchor,
   are one cell. Equal cells have one first holder; only where cells of an anchor differ, and some are not covered, one
   copy of each is cut into its windows, and each window is linked to its first holder.

A stretch that repeats one word or a few in a short cycle has the same k-mers again and again. They are all seeds, and
numbered from the start of the stretch, so its repeats match one to one and chain like any other seeds.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attesta.llm.common import MIX, drop, groups, hashed_words, kmers, slices, stage

K, WINDOW = 5, 12
#: Share of k-mers that are seeds for their hash alone.
DENSITY = 0.2
#: Words of the spans whose seeds are hashed where they point to several places.
SPANS = (12, 24, 32)
#: A passage has at least so many words on either side and so large a share of equal words.
MIN_WORDS, MIN_IDENTITY = 40, 0.8
#: Matches further apart than this (words) on either side are not chained, but each extended for itself; the gap cost per word.
MAX_GAP, GAP_COST = 64, 0.02
#: Characters of text taken on either side of a chain at first, for its extension.
MARGIN = 768
_WORD = re.compile(r"[^ \t-\r]+")


def chosen(codes: np.ndarray, window: int = WINDOW, density: float = DENSITY) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the seeds among the k-mers of a text, and their codes.

    In stretches that repeat in a cycle of at most `window` words every k-mer is a seed, and its number in the stretch
    goes into the code.
    """
    some = codes < np.uint64(int(density * 2**64))
    # a window without a small code has a minimizer of its own
    sums = np.concatenate([[0], np.cumsum(some)])
    bare = sums[window:] == sums[:-window] if len(codes) >= window else np.array([not some.any()])
    if len(codes) and (lone := np.flatnonzero(bare)).size:
        wide = min(window, len(codes))
        some[lone + codes[lone[:, None] + np.arange(wide)].argmin(1)] = True
    cyclic = np.zeros(len(codes), bool)
    for period in range(1, min(window, len(codes) - 1) + 1):
        again = codes[period:] == codes[:-period]
        if again.any():
            cyclic[period:] |= again
            cyclic[:-period] |= again
    if not cyclic.any():
        at = np.flatnonzero(some)
        return at, codes[at]
    at = np.flatnonzero(some | cyclic)
    code = codes[at]
    order = np.lexsort((at, code))
    again = np.concatenate([[False], (np.diff(at[order]) <= window) & (code[order][1:] == code[order][:-1])])
    n = np.arange(len(at))
    with np.errstate(over="ignore"):
        code[order] ^= (n - np.maximum.accumulate(np.where(again, 0, n))).astype(np.uint64) * MIX
    return at, code


def _headed(place: np.ndarray, code: np.ndarray) -> np.ndarray:
    """place, and its complement where the code has occurred in the text before."""
    head = np.zeros(len(code), bool)
    head[np.unique(code, return_index=True)[1]] = True
    return np.where(head, place, ~place)


def seeds(docs: DataFrame, k: int = K, window: int = WINDOW, density: float = DENSITY) -> DataFrame:
    """id, seed and place of the seeds of every text.

    place has the word number in the high half of the long and the code point offset in the low half; it is
    complemented where the seed is not the first of its code in the text.
    """
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2 << 20):
            rows, codes, places = [], [], []
            for row, text in enumerate(b.column(1).to_pylist()):
                words, starts, _ = hashed_words(text)
                at, code = chosen(kmers(words, k), window, density)
                if len(at):
                    rows.append(np.full(len(at), row))
                    codes.append(code)
                    places.append(_headed(at << 32 | starts[at], code))
            if rows:
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(codes).view(np.int64)), pa.array(np.concatenate(places))], ["id", "seed", "place"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, seed bigint, place bigint")


def linked_first(spark: SparkSession, own: DataFrame, name: str) -> DataFrame:
    """Staged: id, seed, source_id, x, y for each seed of own (staged, dropped here) that two documents have, with its earliest holder (in the holder's own rows too)."""
    first = own.groupBy("seed").agg(F.min("id").alias("source_id"), F.max("id").alias("last"), F.min_by("place", F.when(F.col("place") >= 0, F.col("id"))).alias("y")).where("source_id <> last").drop("last")
    first = stage(spark, first, f"{name}-first")
    drop(spark, shuffles=True)
    place = F.when(F.col("place") < 0, F.bitwise_not("place")).otherwise(F.col("place"))
    held = stage(spark, own.join(first, "seed").select("id", "seed", "source_id", place.alias("x"), "y"), f"{name}-held")
    drop(spark, own, first, shuffles=True)
    return held


@functools.cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    base = int(MIX)
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, np.uint64(x))])) for x in (base, pow(base, -1, 1 << 64)))


def spans(held: DataFrame, lengths: tuple[int, ...] = SPANS, density: float = DENSITY) -> DataFrame:
    """id, seed and place, as of seeds, of every span of shared seeds (id, seed, source_id, x, y) that point to several places.

    A span begins at a seed and has all seeds within so many words. Only seeds that are chosen for their hash count, so
    equal words give equal spans wherever they stand.
    """
    kind = held.schema["id"].dataType.simpleString()
    limit = np.uint64(int(density * 2**64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in groups(batches, 1):
            seed, x, y = (np.concatenate([b.column(c).to_numpy() for b in parts]) for c in (1, 3, 4))
            source = pa.concat_arrays([b.column(2) for b in parts])
            source = (source if pa.types.is_integer(source.type) else source.dictionary_encode().indices).to_numpy()
            some = seed.view(np.uint64) < limit
            seed, x, y, source = seed[some].view(np.uint64), x[some], y[some], source[some]
            if len(seed) < 3:
                continue
            at = x >> 32
            # where the place that a seed points to is not the one that goes on from its predecessor's
            turn = np.concatenate([[0], np.cumsum((source[1:] != source[:-1]) | (np.diff(at) != np.diff(y >> 32)))])
            if not turn[-1]:
                continue
            up, down = _powers(1 << int(at[-1]).bit_length())
            with np.errstate(over="ignore"):
                sums = np.concatenate([[np.uint64(0)], np.cumsum(seed * up[at])])
                for length in lengths:
                    end = np.searchsorted(at, at + length)
                    s = np.flatnonzero((turn[end - 1] != turn) & (end - np.arange(len(at)) >= 3))
                    if len(s):
                        code = (sums[end[s]] - sums[s]) * down[at[s]]
                        code = (code ^ (code >> np.uint64(31)) ^ np.uint64(length)) * MIX
                        yield pa.RecordBatch.from_arrays([parts[0].column(0).take(pa.array(np.zeros(len(s), np.int64))), pa.array(code.view(np.int64)), pa.array(_headed(x[s], code))], ["id", "seed", "place"])

    return held.select("id", "seed", "source_id", "x", "y").repartition("id").sortWithinPartitions("id", "x").mapInArrow(run, f"id {kind}, seed bigint, place bigint")


def thinned(x: np.ndarray, y: np.ndarray, step: int = 30) -> np.ndarray:
    """Indices of matches to chain: each once; of those on one diagonal, no further apart than `step` words, one for every `step` words, the first and the last."""
    order = np.lexsort((x, y - x))
    x, y = x[order], y[order]
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
    order, x, y = order[new], x[new], y[new]
    start = np.concatenate([[True], (y[1:] - x[1:] != y[:-1] - x[:-1]) | (np.diff(x) > step)])
    begun = x[np.maximum.accumulate(np.where(start, np.arange(len(x)), 0))]
    cell = (x - begun) // step
    keep = start | np.concatenate([[False], cell[1:] != cell[:-1]]) | np.concatenate([start[1:], [True]])
    return order[keep]


class Fenwick:
    """Prefix maxima with the index that attains them, over positions 1 to n; positions can be reset to nothing."""

    def __init__(self, n: int):
        self.n, self.best, self.who = n, [-math.inf] * (n + 1), [-1] * (n + 1)

    def put(self, i: int, value: float, who: int) -> None:
        while i <= self.n:
            if value > self.best[i]:
                self.best[i], self.who[i] = value, who
            i += i & -i

    def get(self, i: int) -> tuple[float, int]:
        value, who = -math.inf, -1
        while i > 0:
            if self.best[i] > value:
                value, who = self.best[i], self.who[i]
            i -= i & -i
        return value, who


def chains(x: np.ndarray, y: np.ndarray, k: int = K, cost: float = GAP_COST, max_gap: int = MAX_GAP) -> list[list[int]]:
    """Disjoint collinear chains of matches (x[i], y[i]), best first.

    A match scores k; following a predecessor at (x', y') < (x, y) costs `cost` for every word of either gap. With
    that cost, the score of a predecessor plus cost * (x' + y') is all that matters about it: a prefix maximum over y'
    in a Fenwick tree, filled in order of x. Where the best of all predecessors is further away than max_gap, the best
    of those within max_gap is taken; they are the last few in order of x.
    """
    order = np.lexsort((y, x))
    ys = np.unique(y)
    rank = np.searchsorted(ys, y) + 1
    tree = Fenwick(len(ys))
    score, before = [0.0] * len(x), [-1] * len(x)
    waiting: list[int] = []
    ordered, xl, yl = order.tolist(), x.tolist(), y.tolist()
    for at, i in enumerate(ordered):
        if waiting and x[waiting[0]] < x[i]:  # matches at the same x are no predecessors of each other
            for j in waiting:
                tree.put(int(rank[j]), score[j] + cost * float(x[j] + y[j]), j)
            waiting = []
        value, who = tree.get(int(rank[i]) - 1)
        gain = value - cost * float(x[i] + y[i])
        if gain > 0 and (xl[i] - xl[who] > max_gap or yl[i] - yl[who] > max_gap):
            gain = 0.0
            while at and xl[i] - xl[j := ordered[at - 1]] <= max_gap:
                at -= 1
                if xl[j] < xl[i] and 0 < yl[i] - yl[j] <= max_gap and (near := score[j] - cost * (xl[i] - xl[j] + yl[i] - yl[j])) > gain:
                    gain, who = near, j
        score[i] = k + max(0.0, gain)
        if gain > 0:
            before[i] = who
        waiting.append(i)
    used, out = set(), []
    for i in sorted(range(len(x)), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and i not in used:
            used.add(i)
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def _run(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the equal beginning of two arrays."""
    n = min(len(a), len(b))
    for size in (64, n):
        diff = np.flatnonzero(a[: min(size, n)] != b[: min(size, n)])
        if len(diff):
            return int(diff[0])
        if size >= n:
            break
    return n


def _gap(a: np.ndarray, b: np.ndarray) -> int:
    """Most words that two short stretches have in common, in order; of equally long ones that agree in half their places, the words that agree there."""
    if len(a) == len(b) and 2 * (same := int((a == b).sum())) >= len(a):
        return same
    row = np.zeros(len(b) + 1, np.int64)
    for w in a:
        step = np.where(b == w, row[:-1] + 1, row[1:])
        row[1:] = np.maximum.accumulate(step)
    return int(row[-1])


def _ungapped(a: np.ndarray, b: np.ndarray, penalty: int, give_up: int) -> tuple[int, int]:
    """How far two stretches are alike word by word, and how many words are equal: the best total of 1 for equal words and -penalty for others, before the total falls below it by more than give_up."""
    n, at, total, best, where, same = min(len(a), len(b)), 0, 0, 0, 0, 0
    equal_so_far, size = 0, 64
    while at < n:
        end = min(at + size, n)
        eq = a[at:end] == b[at:end]
        run = total + np.cumsum(np.where(eq, 1, -penalty))
        top = np.maximum(np.maximum.accumulate(run), best)
        stop = np.flatnonzero(top - run > give_up)
        m = int(stop[0]) if len(stop) else len(run)
        if m and (peak := int(run[:m].argmax())) >= 0 and run[peak] > best:
            best, where = int(run[peak]), at + peak + 1
            same = equal_so_far + int(eq[: peak + 1].sum())
        if len(stop):
            break
        total, at, equal_so_far, size = int(run[-1]), at + len(run), equal_so_far + int(eq.sum()), 4096
    return where, same


#: Words left out on either side where a stretch goes on, the likeliest first.
_SHIFTS = np.array([(0, 1), (1, 0), (1, 2), (2, 1), (0, 2), (2, 0), (1, 3), (3, 1), (2, 3), (3, 2), (0, 3), (3, 0)])
_EIGHT = np.arange(8)


def _extend(a: np.ndarray, b: np.ndarray, penalty: int = 2, give_up: int = 12) -> tuple[int, int, int]:
    """How far two stretches go on alike: words taken of each and equal words. Words may be changed, and up to three left out or put in where six of the eight that follow are equal."""
    i = j = same = 0
    while True:
        n, equal = _ungapped(a[i:], b[j:], penalty, give_up)
        i, j, same = i + n, j + n, same + equal
        room = (_SHIFTS[:, 0] <= len(a) - i - 8) & (_SHIFTS[:, 1] <= len(b) - j - 8)
        if not room.any():
            return i, j, same
        shifts = _SHIFTS[room]
        eq = a[i + shifts[:, :1] + _EIGHT] == b[j + shifts[:, 1:] + _EIGHT]
        on = np.flatnonzero(eq[:, 0] & (eq.sum(1) >= 6))
        if not len(on):
            return i, j, same
        i, j = i + int(shifts[on[0], 0]), j + int(shifts[on[0], 1])


def align(a: np.ndarray, b: np.ndarray, anchors: list[tuple[int, int]], k: int = K, penalty: int = 2) -> tuple[int, int, int, int, int]:
    """The passage around a chain: start and end in each word array, and the number of equal words."""
    x0, y0 = anchors[0]
    back = _extend(a[:x0][::-1], b[:y0][::-1], penalty)
    start_a, start_b, same = x0 - back[0], y0 - back[1], back[2]
    i, j = x0, y0
    for x, y in anchors:
        if x < i or y < j:
            continue  # inside what is aligned already
        if x > i or y > j:
            same += _gap(a[i:x], b[j:y])
        n = _run(a[x:], b[y:])
        i, j, same = x + n, y + n, same + n
    more = _extend(a[i:], b[j:], penalty)
    return start_a, i + more[0], start_b, j + more[1], same + more[2]


def aligned(a: np.ndarray, b: np.ndarray, anchors: list[tuple[int, int]], k: int, min_words: int, min_identity: float) -> list[tuple[int, int, int, int, int]]:
    """Passages around a chain: one around all of it; where that has too few equal words, those around its seeds, at least of their equal words. No other way reaches further than the first."""
    good = lambda p: min(p[1] - p[0], p[3] - p[2]) >= min_words and p[4] >= min_identity * max(p[1] - p[0], p[3] - p[2])
    for penalty in (2, 4):
        if good(found := align(a, b, anchors, k, penalty)):
            return [found]
        if penalty == 2 and min(found[1] - found[0], found[3] - found[2]) < min_words:
            return []
    out: list[tuple[int, int, int, int, int]] = []
    for anchor in anchors:
        if out and anchor[0] < out[-1][1]:
            continue
        for penalty in (2, 4):
            if good(found := align(a, b, [anchor], k, penalty)):
                out.append(found)
                break
        else:  # what is around lowers the share too far: the equal words alone
            (x, y), back = anchor, _run(a[: anchor[0]][::-1], b[: anchor[1]][::-1])
            if (n := back + _run(a[x:], b[y:])) >= min_words:
                out.append((x - back, x - back + n, y - back, y - back + n, n))
    return out


def _window_codes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every `size` consecutive words, by differences of prefix sums."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    return _stretch_codes(words, np.arange(len(words) - size + 1), np.arange(size, len(words) + 1))


def _stretch_codes(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of each of the stretches words[first:last]."""
    up, down = _powers(1 << len(words).bit_length())
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(words * up[: len(words)])])
        code = (sums[last] - sums[first]) * down[first]
        code = (code ^ (code >> np.uint64(31)) ^ (last - first).astype(np.uint64)) * MIX
        return code ^ (code >> np.uint64(32))


def cut_cells(words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of a text: first word and end of each, hash of its anchor, and hash of its words.

    The anchor of a window of `size` words is its smallest k-mer of two fifths as many words, the first of equal ones;
    consecutive windows with one anchor are a cell. Of a cell that comes again within WINDOW words, as in a stretch that
    repeats itself in a short cycle, only the first is given.
    """
    k = max(1, 2 * size // 5)
    windows = len(words) - size + 1
    if windows <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    codes = _window_codes(words, k)
    at, wide = np.arange(len(codes)), 1
    while wide < size - k + 1:
        step = min(wide, size - k + 1 - wide)
        left, right = at[:-step], at[step:]
        at, wide = np.where(codes[right] < codes[left], right, left), wide + step
    begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    end = np.concatenate([begin[1:], [windows]]) + size - 1
    anchor = codes[at[begin]]
    with np.errstate(over="ignore"):
        cell = _stretch_codes(words, begin, end) ^ (at[begin] - begin).astype(np.uint64) * MIX
    order = np.lexsort((begin, cell))
    again = np.concatenate([[False], (cell[order][1:] == cell[order][:-1]) & (np.diff(begin[order]) <= WINDOW)])
    some = np.sort(order[~again])
    return begin[some], end[some], anchor[some], cell[some]


def cells(docs: DataFrame, size: int) -> DataFrame:
    """id, anchor, cell, start and end (code points) and at (number of the first word) of the cells of every text."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2 << 20):
            rows, found = [], []
            for row, text in enumerate(b.column(1).to_pylist()):
                words, starts, ends = hashed_words(text)
                first, last, anchor, cell = cut_cells(words, size)
                if len(first):
                    rows.append(np.full(len(first), row))
                    found.append((anchor.view(np.int64), cell.view(np.int64), starts[first], ends[last - 1], first))
            if rows:
                columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(rows))), *columns], ["id", "anchor", "cell", "start", "end", "at"])

    return docs.select("id", "text").mapInArrow(run, f"id {kind}, anchor bigint, cell bigint, start bigint, end bigint, at bigint")


def cell_windows(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """anchor, code, id, cell, start, end and at of every window of the wanted cells (columns of cells)."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2 << 20):
            rows, found = [], []
            for row, (text, several) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                for c in several:
                    words, starts, ends = hashed_words(text[c["start"] : c["end"]])
                    code = _window_codes(words, size)
                    n = len(code)
                    rows.append(np.full(n, row))
                    found.append((np.full(n, c["anchor"]), code.view(np.int64), np.full(n, c["cell"]), starts[:n] + c["start"], ends[size - 1 :] + c["start"], np.arange(n) + c["at"]))
                if len(rows) >= 4096 or row == b.num_rows - 1 and rows:
                    columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.concatenate(rows))), *columns], ["id", "anchor", "code", "cell", "start", "end", "at"])
                    rows, found = [], []

    lists = wanted.groupBy("id").agg(F.collect_list(F.struct("anchor", "cell", "start", "end", "at")).alias("cells"))
    return docs.select("id", "text").join(lists.hint("shuffle_merge"), "id").mapInArrow(run, f"id {kind}, anchor bigint, code bigint, cell bigint, start bigint, end bigint, at bigint")


def whole_windows(spark: SparkSession, docs: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """Staged: id, source_id, x, y: pairs of stretches of at least `size` equal words, [start, end] each, of which no single found passage (id, start, end) covers the first.

    Every window of `size` words that a document shares with an earlier one is in a found passage or in such a stretch,
    but for windows of a short cycle after the first ones (numbered seeds match those).
    """
    kind = docs.schema["id"].dataType.simpleString()
    every = stage(spark, cells(docs, size), "substring-cells")
    shared = every.groupBy("anchor").agg(F.min("id").alias("lowest"), F.max("id").alias("highest"), (F.min("cell") != F.max("cell")).alias("mixed")).where("lowest <> highest").drop("highest")
    kept = stage(spark, every.join(shared, "anchor"), "substring-cells-shared")
    drop(spark, every)

    # cells that no passage covers: passages come first where they start together
    both = kept.withColumn("passage", F.lit(False)).unionByName(found.select("id", "start", "end", F.lit(True).alias("passage")), allowMissingColumns=True)
    before = Window.partitionBy("id").orderBy("start", F.desc("passage")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = F.max(F.when(F.col("passage"), F.col("end"))).over(before)
    bare = stage(spark, both.withColumn("reached", reached).where("NOT passage AND (reached IS NULL OR reached < end) AND id <> lowest").drop("passage", "reached"), "substring-cells-bare")

    first = F.min(F.struct("id", "start", "end", "at", "cell")).alias("first")
    firsts = stage(spark, kept.join(bare.select("anchor").distinct(), "anchor", "left_semi").groupBy("anchor", "cell").agg(first, F.first("mixed").alias("mixed")), "substring-cells-first")
    linked = bare.join(firsts.select("anchor", "cell", "first"), ["anchor", "cell"])
    same = linked.where("id <> first.id").select("id", "start", "end", "at", "first")
    # cells that are the first of their kind, but not of their anchor: their windows may be in other cells
    own = linked.where("mixed AND id = first.id").select("anchor", "id", "start", "end", "at", "cell")
    wanted = firsts.join(own.select("anchor").distinct(), "anchor", "left_semi").select("anchor", "first.*").union(own).distinct()
    windows = stage(spark, cell_windows(docs, wanted, size), "substring-windows")
    holders = windows.groupBy("anchor", "code").agg(first)
    alike = windows.join(holders, ["anchor", "code"]).where("id <> first.id").select("id", "start", "end", "at", "first")

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts in groups(batches, 2):
            start, end, at, start2, end2, at2 = (np.concatenate([b.column(c).to_numpy() for b in parts]) for c in range(2, 8))
            order = np.lexsort((at, at2 - at))
            start, end, at, start2, end2, at2 = (c[order] for c in (start, end, at, start2, end2, at2))
            new = np.concatenate([[True], (np.diff(at2 - at) != 0) | (start[1:] > end[:-1])])
            begin = np.flatnonzero(new)
            pairs = [pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(begin) + 1, 2, dtype=np.int32)), pa.array(np.stack([a[begin], np.maximum.reduceat(b, begin)], 1).ravel().astype(np.int32))) for a, b in ((start, end), (start2, end2))]
            ids = [parts[0].column(c).take(pa.array(np.zeros(len(begin), np.int64))) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([*ids, *pairs], ["id", "source_id", "x", "y"])

    links = same.union(alike).select("id", F.col("first.id").alias("source_id"), "start", "end", "at", *(F.col(f"first.{c}").alias(f"source_{c}") for c in ("start", "end", "at")))
    links = links.repartition("id", "source_id").sortWithinPartitions("id", "source_id")
    out = stage(spark, links.mapInArrow(merged, f"id {kind}, source_id {kind}, x array<int>, y array<int>"), "substring-exact")
    drop(spark, kept, bare, firsts, windows)
    return out


def cut_out(rows: DataFrame, linked: DataFrame, margin: int) -> DataFrame:
    """chain, id, source_id, x, y, and the stretches of both texts around each chain: a and b (lo, more, part).

    The stretches are cut out in the JVM, where the texts are joined; a source that thousands of documents repeat is a
    hot key of that join only, which splits.
    """
    sides = [linked.select("chain", F.lit(side).alias("side"), F.col(who).alias("id"), F.greatest(F.array_min(p) - margin, F.lit(0)).alias("lo"), (F.array_max(p) + margin).alias("hi")) for side, who, p in ((0, "id", "x"), (1, "source_id", "y"))]
    cut = rows.join(sides[0].union(sides[1]).hint("shuffle_merge"), "id").select("chain", "side", "lo", F.col("text").substr(F.col("lo") + 1, F.col("hi") - F.col("lo")).alias("part"), (F.col("hi") < F.length("text")).alias("more"))
    cut = cut.withColumn("s", F.struct("lo", "more", "part"))
    return cut.groupBy("chain").agg(F.min(F.when(F.col("side") == 0, F.col("s"))).alias("a"), F.min(F.when(F.col("side") == 1, F.col("s"))).alias("b")).join(linked, "chain").select("chain", "id", "source_id", "x", "y", "a", "b")


def passages(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS, min_identity: float = MIN_IDENTITY, margin: int = MARGIN
) -> DataFrame:
    """Repeated passages, one row each: id, start, end (code points, end exclusive) of the later copy; source_id,
    source_start, source_end of an earlier one; n_words (of the later copy), equal_words, identity.

    Ids order documents: the smallest holder of a passage is its source and has no row of its own for it. Equal texts
    are one passage from end to end. A passage that several earlier documents hold in parts has a row for each. Every
    stretch of min_words equal words that an earlier document holds is in a passage. Rows
    with a null id or text, and texts of fewer than min_words words, have no passages. Ids should be unique; where one
    is not, passages are still found, but only in the copy that sorts first. Further columns are not read; an empty
    table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    held = linked_first(spark, stage(spark, seeds(rows, k, window), "substring-seeds"), "substring")
    wide = linked_first(spark, stage(spark, spans(held), "substring-spans"), "substring-wide")
    matches = held.union(wide).where("id <> source_id").select("id", "source_id", "x", "y")

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "source_id", "x", "y"]
        rows, xs, ys = [], [], []

        def out() -> pa.RecordBatch:
            ids = [pa.concat_arrays([r.column(c) for r in rows]) for c in (0, 1)]
            return pa.RecordBatch.from_arrays([*ids, pa.array(xs, pa.list_(pa.int32())), pa.array(ys, pa.list_(pa.int32()))], names)

        for parts in groups(batches, 2):
            x, y = (np.concatenate([b.column(c).to_numpy() for b in parts]) for c in (2, 3))
            if len(x) < 2:
                continue
            some = thinned(x >> 32, y >> 32)
            x, y = x[some], y[some]
            for chain in chains(x >> 32, y >> 32, k):
                if len(chain) >= 2:
                    rows.append(parts[0].slice(0, 1))
                    xs.append((x[chain] & 0xFFFFFFFF).tolist())
                    ys.append((y[chain] & 0xFFFFFFFF).tolist())
            if len(rows) >= 4096:
                yield out()
                rows, xs, ys = [], [], []
        if rows:
            yield out()

    pairs = matches.repartition("id", "source_id").sortWithinPartitions("id", "source_id", "x")
    todo = stage(spark, pairs.mapInArrow(chained, f"id {kind}, source_id {kind}, x array<int>, y array<int>").withColumn("chain", F.monotonically_increasing_id()), "substring-chains")
    drop(spark, held, wide, shuffles=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:

        def words(s: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Hashes, starts and ends (in the text) of the whole words of a stretch."""
            h, first, last = hashed_words(s["part"])
            i = int(bool(s["lo"] and len(h) and first[0] == 0))
            j = len(h) - int(bool(s["more"] and len(h) and last[-1] == len(s["part"])))
            return h[i:j], first[i:j] + s["lo"], last[i:j] + s["lo"]

        names = ["start", "end", "source_start", "source_end", "n_words", "equal_words"]
        for b in slices(batches, 2 << 20):
            rows, cut, out = [], [], [[] for _ in names]
            for row, (xs, ys, a, c) in enumerate(zip(*(col.to_pylist() for col in b.columns[3:]))):
                (h, at, end), (h2, at2, end2) = words(a), words(c)
                places, places2 = (np.searchsorted(p, q) for p, q in ((at, xs), (at2, ys)))
                anchors = [(i, j) for i, j, x, y in zip(places.tolist(), places2.tolist(), xs, ys) if i < len(at) and j < len(at2) and at[i] == x and at2[j] == y]
                anchors = [(i, j) for i, j in anchors if (h[i : i + k] == h2[j : j + k]).all()]
                for i, j, i2, j2, same in aligned(h, h2, anchors, k, min_words, min_identity) if anchors else ():
                    rows.append(row)
                    # an extension that comes to where a text was cut may go on beyond
                    cut.append(bool((a["lo"] and i < 8) or (a["more"] and j > len(h) - 8) or (c["lo"] and i2 < 8) or (c["more"] and j2 > len(h2) - 8)))
                    for column, v in zip(out, (at[i], end[j - 1], at2[i2], end2[j2 - 1], j - i, same)):
                        column.append(int(v))
            if rows:
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(rows)) for c in range(3)), *(pa.array(c, pa.int64()) for c in out), pa.array(cut)], ["chain", id_col, "source_id", *names, "cut"])

    results: list[DataFrame] = []

    def settle(todo: DataFrame, margin: int) -> None:
        """Add the passages of all chains to results."""
        while True:
            schema = f"chain bigint, `{id_col}` {kind}, source_id {kind}, start bigint, end bigint, source_start bigint, source_end bigint, n_words bigint, equal_words bigint, cut boolean"
            found = stage(spark, cut_out(rows, todo, margin).mapInArrow(run, schema), "substring-found")
            again = found.where("cut").select("chain").distinct()
            results.append(found.join(again, "chain", "left_anti").drop("chain", "cut"))
            if again.isEmpty():
                return
            todo, margin = stage(spark, todo.join(again, "chain", "left_semi"), "substring-chains-again"), 16 * margin

    settle(todo, margin)
    found = functools.reduce(DataFrame.union, results).select(F.col(id_col).alias("id"), "start", "end").distinct()
    exact = whole_windows(spark, rows, found, min_words)
    settle(stage(spark, exact.withColumn("chain", F.monotonically_increasing_id()), "substring-exact-chains"), margin)
    return functools.reduce(DataFrame.union, results).withColumn("identity", F.col("equal_words") / F.col("n_words")).distinct()


def without_passages(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with every repeated passage cut out of its later copies; a text left without a word goes. All columns stay.

    Rows with a null id or text stay as they are. Of repeated ids all rows are cut alike.
    """
    spans = passages(spark, docs, id_col, text_col, **options).groupBy(id_col).agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("_spans"))
    spans = stage(spark, spans, "substring-spans")
    schema = docs.schema
    extra = "_spans" + "_" * max(map(len, docs.columns))  # longer than any name of theirs
    spans = spans.withColumnRenamed("_spans", extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            at = b.schema.get_field_index(text_col)
            texts, keep = [], []
            for text, cut in zip(b.column(at).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                if text is not None and cut:
                    out, end = [], 0
                    for s in cut:
                        out.append(text[end : max(end, s["start"])])
                        end = max(end, s["end"])
                    text = "".join([*out, text[end:]])
                    keep.append(bool(_WORD.search(text)))
                else:
                    keep.append(True)
                texts.append(text)
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays(columns, schema.names).filter(pa.array(keep))

    return docs.join(spans.hint("shuffle_merge"), id_col, "left").select(*schema.names, extra).mapInArrow(run, schema)
