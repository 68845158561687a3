"""Language-model scores by online logistic context mixing.

A text is the sequence of its lower-cased words, each spelled in bytes with a closing space, and an end mark. Every
bit of a byte is predicted from several contexts (the last bytes of the word, its whole beginning, and that beginning
after the word before it), each hashed into a table of counts of zeros and ones, where the nodes of half a byte share a
line of 16 slots; the tables are summed over the running training texts. What words share is computed once: the bits of
equal beginnings, and, but for learning, equal pairs of words. The predictions are combined in the logistic domain by
two layers: contexts within the word with weights chosen by how often the word's beginning has been seen, and their sum with the context across words, with weights chosen
by how often that has been seen. The weights are learned online, each word predicted with its own occurrence taken out of
the counts and then learned from: the first layer's, which see nothing outside a word, over all distinct words by how
often they occur, the second layer's over all running training texts bit by bit. Within a document
the result is refined adaptively: a word's probability is mixed with its frequency in training and with its frequency
in the document so far (as a whole, and after the word before it), over a grid of mixing rates weighted by how well each
has predicted the document up to there.
The total is the log probability of the text, and its bits per byte.

The tables have a fixed size, so the model can be broadcast at any size of the corpus. The exact word counts, which
grow with it, are never broadcast: documents are dealt into blocks of bounded size, and only counts of words that occur
in a block are joined to it.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import bounded_batches, drop, slices, stage

END = b"\n"
_UPPER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Slots of each predictor's table, as powers of two: for the last 0 to 4 bytes, and for the word's whole beginning.
SLOT_BITS = (12, 16, 18, 19, 19, 20)
PREDICTORS = len(SLOT_BITS)
_BASES = np.cumsum([0, *(1 << b for b in SLOT_BITS)])
SLOTS = int(_BASES[-1])
GATES = 12
#: Slots of the table across words, as a power of two.
ACROSS_BITS = 22
#: Bytes of running text whose distinct words are spelled at a time.
STRETCH = 6 << 20
#: Slots that one row of the summed tables holds.
CHUNK = 1 << 14
#: Bytes of text that a block of documents aims at.
BLOCK_BYTES = 24 << 20
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ROLL = 0x100000001B3
_UNROLL = pow(_ROLL, -1, 1 << 64)
#: Mixing rates of the two refinements.
WORD_RATES, CACHE_RATES = np.array([0.02, 0.5, 0.8, 0.9, 0.96, 0.99]), np.array([0.001, 0.05, 0.15, 0.3, 0.5])


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().translate(_UPPER).split(), END]


def _spell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words with their closing marks, one after the other, and the length of each."""
    marked = [w if w == END else w + b" " for w in words]
    return np.frombuffer(b"".join(marked), np.uint8), np.fromiter(map(len, marked), np.int64, len(marked))


def _powers(n: int, base: int) -> np.ndarray:
    return _all_powers(max(12, (n - 1).bit_length()), base)[: n + 1]


@functools.lru_cache(32)
def _all_powers(bits: int, base: int) -> np.ndarray:
    n = 1 << bits
    with np.errstate(over="ignore"):
        return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(base))]))


def _before(raw: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For every byte, a hash of what stands before it in its word. place: that of every byte in its word."""
    out = np.empty(len(raw), np.uint64)
    heads = np.flatnonzero(place == 0)
    cuts = [*heads[np.flatnonzero(np.diff(heads >> 18, prepend=-1))].tolist(), len(raw)]
    for i, j in zip(cuts, cuts[1:]):  # whole words, some quarter million bytes at a time
        own = place[i:j]
        start = np.arange(j - i) - own
        up, down = _powers(j - i, _ROLL), _powers(j - i, _UNROLL)
        with np.errstate(over="ignore"):
            sums = np.concatenate([[np.uint64(0)], np.cumsum((raw[i:j].astype(np.uint64) + np.uint64(1)) * up[:-1])])
            out[i:j] = (sums[:-1] - sums[start]) * down[start] + np.minimum(own, 255).astype(np.uint64)
    return out


def _places(lengths: np.ndarray) -> np.ndarray:
    """Of every byte, its place in its word."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


#: Of every byte and its bits, highest first: the node among the bits of its half, 1 to 15, and twice that with the bit itself.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
_NODES = np.array([[(1 << k % 4) + (b >> (8 - k) & ((1 << k % 4) - 1)) for k in range(8)] for b in range(256)])
_NODES_BITS = 2 * _NODES + _BITS
#: Bits are counted by gate and place in the byte: sums in one place would wait for each other.
_LANES = 16 * np.arange(8)
_SIGNS = (2 * _BITS.astype(np.float32)) - 1
#: What tells the second half of a byte from the first: its first four bits.
_HIGH = (np.arange(256, dtype=np.uint64) // np.uint64(16) + np.uint64(1)) * _STEP


def _halves(context: np.ndarray, raw: np.ndarray, size: int) -> np.ndarray:
    """For both halves of a byte after a (mixed) context: the slot whose last four bits are turned over by the node. The nodes of a half lie in one line of 16 slots."""
    out = np.empty((len(raw), 2), np.uint64)
    with np.errstate(over="ignore"):
        np.multiply(context, _MIX, out=out[:, 0])
        np.multiply(context ^ _HIGH[raw], _MIX, out=out[:, 1])
    out >>= np.uint64(64 - size)
    return out.view(np.int64)


def _along(halves: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Slots [byte, bit] from those of the halves."""
    return (halves[:, :, None] ^ nodes.reshape(-1, 2, 4)).reshape(-1, 8)


def _contexts(raw: np.ndarray, place: np.ndarray, before: np.ndarray, at: np.ndarray | None = None) -> list[np.ndarray]:
    """For the bytes at some places of raw, their contexts for each predictor. place: of every byte, that in its word; before: hashes of what stands before it there."""
    at = np.arange(len(raw)) if at is None else at
    own = place[at]
    with np.errstate(over="ignore"):
        contexts, last = [np.minimum(own, 3).astype(np.uint64)], np.zeros(len(at), np.uint64)
        for k in range(1, 5):
            back = (raw.take(at - k, mode="clip").astype(np.uint64) + np.uint64(1)) * (own >= k)
            last = last * np.uint64(257) + back
            contexts.append(last)
        return [*contexts, before[at]]


def _slots(contexts: list[np.ndarray], raw: np.ndarray, nodes: np.ndarray, each: int = 1) -> Iterator[np.ndarray]:
    """For each predictor, slots [byte, bit] in the joint table; nodes: those of raw, in a table with `each` entries for a slot."""
    for p, context in enumerate(contexts):
        with np.errstate(over="ignore"):
            halves = _halves((context + np.uint64(p + 1)) * _MIX, raw, SLOT_BITS[p])
        yield _along((halves + _BASES[p]) * each, nodes)


def bit_slots(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte: slots [predictor, byte, bit] in the joint table, and its bits [byte, bit], highest first."""
    place = _places(lengths)
    return np.stack(list(_slots(_contexts(raw, place, _before(raw, place)), raw, _NODES[raw]))), _BITS[raw]


def _beginnings(raw: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words share what stands at their beginnings: for every byte, a number for it and all before it in its word, and for every number the first such byte. before: hashes of what stands before."""
    with np.errstate(over="ignore"):
        key = (before * _MIX + raw) * _STEP
    number = pa.array(key).dictionary_encode().indices.to_numpy()
    first = np.empty(int(number.max(initial=-1)) + 1, np.int64)
    first[number[::-1]] = np.arange(len(raw))[::-1]
    return number, first


def encoded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """tokens() of many texts: the distinct words but the end mark, in binary; the numbers of all words of all texts, from 1, and 0 for the end mark; how many each text has."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    sizes, words = parts.value_lengths().to_numpy(), parts.flatten()
    some = pc.binary_length(words).to_numpy() > 0  # white space at an end leaves an empty word
    words = words.filter(pa.array(some)).dictionary_encode()
    text = np.repeat(np.arange(len(sizes)), sizes)[some]
    sizes = np.bincount(text, minlength=len(sizes)).astype(np.int64) + 1
    ids = np.zeros(int(sizes.sum()), np.int64)
    ids[np.arange(len(text)) + text] = words.indices.to_numpy() + 1
    return words.dictionary.cast(pa.binary()), ids, sizes


class Running:
    """Some running texts: their distinct words, and for every word of them its number and that of the word before it. A text begins after an end mark, whose number is 0."""

    def __init__(self, texts: list[list[bytes]] | pa.Array):
        if isinstance(texts, list):
            index: dict[bytes, int] = {END: 0}
            self.ids = np.fromiter((index.setdefault(w, len(index)) for words in texts for w in words), np.int64)
            words, self.sizes = pa.array(list(index)[1:], pa.binary()), np.fromiter(map(len, texts), np.int64, len(texts))
        else:
            words, self.ids, self.sizes = encoded(texts)
        #: The distinct words but the end mark.
        self.words = words
        self.before = np.concatenate([[0], self.ids[:-1]])  # every text ends with an end mark
        sizes = np.concatenate([[0], pc.binary_length(words).to_numpy()]).astype(np.int64)
        self.lengths = sizes + 1
        self.lengths[0] = len(END)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.raw = np.full(int(self.lengths.sum()), ord(" "), np.uint8)
        self.raw[0] = ord(END)
        if len(words):
            flat = pa.concat_arrays([words])  # without an offset
            _, ends, letters = flat.buffers()
            at = np.frombuffer(ends, np.int32)[flat.offset : flat.offset + len(flat) + 1]
            self.raw[np.arange(at[-1] - at[0]) + np.repeat(np.arange(1, len(flat) + 1), sizes[1:])] = np.frombuffer(letters, np.uint8)[at[0] : at[-1]] if letters else 0
        self.place = _places(self.lengths)
        self.hashes = _before(self.raw, self.place)
        last = self.starts + self.lengths - 1
        with np.errstate(over="ignore"):
            whole = (self.hashes[last] * _MIX ^ self.lengths.astype(np.uint64)) * _STEP
        #: Of every word, what a pair with it needs, side by side.
        self.facts = np.stack([self.starts, self.lengths, whole.view(np.int64)], 1)

    def bits(self, before: np.ndarray, ids: np.ndarray, nodes: np.ndarray, each: int = 1, size: int = 1 << 15) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """About `size` bytes of words after others at a time: which words, their lengths, the places of their bytes in raw, and slots [byte, bit] across words, in a table with `each` entries for a slot."""
        ends = np.cumsum(self.lengths[ids])
        cuts = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), len(ids)]
        for i, j in zip(cuts, cuts[1:]):
            facts = self.facts.take(ids[i:j], 0)
            n, whole = facts[:, 1], self.facts.take(before[i:j], 0)[:, 2].view(np.uint64)
            at = np.arange(int(n.sum())) + np.repeat(facts[:, 0] - (np.cumsum(n) - n), n)
            raw = self.raw[at]
            with np.errstate(over="ignore"):
                halves = _halves((self.hashes[at] * _MIX + np.repeat(whole, n)) * _MIX, raw, ACROSS_BITS)
            yield slice(i, j), n, at, _along(halves * each, nodes.take(raw, 0))


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of some `size` bytes, made of smaller ones."""
    held, n = [], 0
    for b in slices(batches, size):
        if held and n + b.nbytes > size:
            yield pa.concat_batches(held)
            held, n = [], 0
        held.append(b)
        n += b.nbytes
    if held:
        yield pa.concat_batches(held)


def stretches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[Running]:
    """The texts of a column of batches, whole, some STRETCH bytes at a time."""
    for b in gathered(batches, STRETCH):
        if b.num_rows:
            yield Running(b.column(column))


def _pieces(words: list[bytes], size: int = 1 << 15) -> Iterator[list[int]]:
    """Indices of words in groups of about `size` bytes."""
    own, held = [], 0
    for i, w in enumerate(words):
        own.append(i)
        held += len(w) + 1
        if held >= size:
            yield own
            own, held = [], 0
    if own:
        yield own


def _stretched(counts: np.ndarray) -> np.ndarray:
    """Log odds of a one; few observations stay near zero. counts[..., 2]: zeros and ones."""
    return np.log((counts[..., 1] + 0.4) / (counts[..., 0] + 0.4))


def _gate(total: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(total + np.float32(1)).astype(np.int64), GATES - 1)


#: Log odds in coded tables are whole numbers of this, sixteen times, with the gate added.
_UNIT = np.float32(2.0**-22)


def _coded(counts: np.ndarray, own: bool) -> np.ndarray:
    """Log odds and gate of every slot in one number: of a one, or, with own, of either bit with one occurrence of it taken out, zeros first."""
    n = len(counts) * (1 + own)
    room = np.empty(n + 32, np.int32)
    out = room[-room.ctypes.data % 128 // 4 :][:n]  # lines of slots are lines of the cache
    for at in range(0, len(counts), 1 << 16):
        c = counts[at : at + (1 << 16)].astype(np.float32)
        if own:
            this, other = np.maximum(c - 1, 0), c[:, ::-1]
        else:
            this, other = c[:, 1], c[:, 0]
        x = np.log((this + np.float32(0.4)) / (other + np.float32(0.4)))
        out[at * (1 + own) :][: x.size] = ((np.rint(x / _UNIT).astype(np.int32) << 4) + _gate(this + other)).ravel()
    return out


def _uncoded(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds, and gates with their lanes."""
    x = (code >> 4).astype(np.float32)
    x *= _UNIT
    return x, (code & 15) + _LANES


def _by_lane(weights: np.ndarray) -> np.ndarray:
    """Weights of the gates, in single precision, where _uncoded points."""
    return np.tile(np.concatenate([weights, np.zeros(16 - GATES)]).astype(np.float32), 8)


def _per_gate(lanes: np.ndarray, amounts: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(lanes, amounts, 128).reshape(8, 16).sum(0)[:GATES]


class Mixer:
    """Gated weights over the predictors, and the spelling cost of words. across: counts by context across words; outer: of each gate the weights of the first layer's sum and of that context.

    Log odds are signed by the bit that is there: what is positive favours it.
    """

    def __init__(self, counts: np.ndarray, weights: np.ndarray | None = None, across: np.ndarray | None = None, outer: np.ndarray | None = None):
        self.counts, self.across = counts, across
        self.weights = np.full((GATES, PREDICTORS), 0.3) if weights is None else weights
        self.outer = np.tile([1.0, 0.3], (GATES, 1)) if outer is None else outer
        self.without = self.without_across = self.coded = None

    def learn(self, words: list[bytes], times: np.ndarray, rate: float = 0.3) -> None:
        """The first layer online, a batch of words at a time: each is predicted with one occurrence taken out of the counts, then the weights move, by how often the words occur."""
        if self.without is None:
            self.without = _coded(self.counts, True)
        for own in _pieces(words, 1 << 12):
            raw, lengths = _spell([words[i] for i in own])
            place = _places(lengths)
            codes = [self.without.take(s) for s in _slots(_contexts(raw, place, _before(raw, place)), raw, _NODES_BITS[raw], 2)]
            x, gate = [(c >> 4).astype(np.float32) * _UNIT for c in codes], (codes[-1] & 15) + _LANES
            z = sum(x[p] * _by_lane(self.weights[:, p]).take(gate, mode="clip") for p in range(PREDICTORS))
            error = 1 / (1 + np.exp(np.clip(z, -30, 30)))
            flat = gate.ravel()
            often = np.repeat(times[own], lengths).astype(np.float64)[:, None]
            n = _per_gate(flat, np.broadcast_to(often, gate.shape).ravel())
            error = error * often
            for p in range(PREDICTORS):
                self.weights[:, p] += rate * np.minimum(1.0, n / 64) * _per_gate(flat, (error * x[p]).ravel()) / np.maximum(n, 1)

    def learn_running(self, text: Running, rate: float = 0.02) -> None:
        """The second layer online, over running text bit by bit, a batch of words at a time: each is predicted with its own occurrence taken out of the counts across words, then the weights move."""
        number, inner = self.sums(text)
        if self.without_across is None:
            self.without_across = _coded(self.across, True)
        for _, _, at, slots in text.bits(text.before, text.ids, _NODES_BITS, 2, 1 << 13):
            z = inner.take(number[at], 0)
            x, gate = _uncoded(self.without_across.take(slots))
            t = z * _by_lane(self.outer[:, 0]).take(gate, mode="clip")
            t += x * _by_lane(self.outer[:, 1]).take(gate, mode="clip")
            np.clip(t, -20, 20, out=t)
            error = np.exp(t, out=t)
            error += 1
            np.divide(1, error, out=error)
            flat = gate.ravel()
            n = _per_gate(flat)
            for p, part in enumerate((z, x)):
                part *= error
                self.outer[:, p] += rate * np.minimum(1.0, n / 64) * _per_gate(flat, part.ravel()) / np.maximum(n, 1)

    def prepare(self) -> None:
        self.odds = _stretched(self.counts.astype(np.float32)).astype(np.float32)
        last = self.counts[_BASES[-2] :].sum(1, dtype=np.int64)
        self.gates = _gate(last).astype(np.int8)
        self.fine = self.weights.astype(np.float32)

    def sums(self, text: Running) -> tuple[np.ndarray, np.ndarray]:
        """The first layer's log odds [number, bit] of all beginnings of a text's distinct words, and the number of each byte of these."""
        number, first = _beginnings(text.raw, text.hashes)
        out, fine = np.empty((len(first), 8), np.float32), [_by_lane(w) for w in self.fine.T]
        for at in range(0, len(first), 1 << 15):
            part = first[at : at + (1 << 15)]
            raw = text.raw[part]
            slots = list(_slots(_contexts(text.raw, text.place, text.hashes, part), raw, _NODES[raw]))
            gate = self.gates.take(slots[-1] - _BASES[-2]).astype(np.int64)
            z = np.zeros(gate.shape, np.float32)
            for p, w in enumerate(fine):
                z += self.odds.take(slots[p]) * w.take(gate, mode="clip")
            np.multiply(np.clip(z, -20, 20), _SIGNS[raw], out=out[at : at + (1 << 15)])
        return number, out

    def costs(self, text: Running) -> np.ndarray:
        """Natural log of the probability of the spelling of every word of a running text, after the word before it."""
        number, inner = self.sums(text)
        if self.coded is None:
            self.coded = _coded(self.across, False)
        # each distinct pair of words once
        both = pa.array(text.before * len(text.lengths) + text.ids).dictionary_encode()
        before, ids = np.divmod(both.dictionary.to_numpy(), len(text.lengths))
        out = np.empty(len(ids))
        for own, lengths, at, slots in text.bits(before, ids, _NODES):
            x, gate = _uncoded(self.coded.take(slots))
            x *= _by_lane(self.outer[:, 1]).take(gate, mode="clip")
            x *= _SIGNS.take(text.raw[at], 0)
            z = inner.take(number[at], 0)
            z *= _by_lane(self.outer[:, 0]).take(gate, mode="clip")
            z += x
            np.clip(z, -20, 20, out=z)
            np.exp(np.negative(z, out=z), out=z)
            z += 1
            # of a half of a byte the product of the inverse probabilities: at most e^80, within single precision
            half = np.multiply(*np.multiply(z[:, 0::2], z[:, 1::2]).reshape(-1, 2, 2).transpose(2, 0, 1))
            out[own] = -np.add.reduceat(np.log(half).sum(1, dtype=np.float64), np.cumsum(lengths) - lengths)
        return out[both.indices.to_numpy()]


def word_counts(docs: DataFrame, text_col: str, limit: int = 400_000) -> DataFrame:
    """word (binary), n: occurrences over all rows; the end mark counts once for each row. Combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for text in gathered(batches, STRETCH):
            words, ids, _ = encoded(text.column(0))
            n = np.bincount(ids, minlength=len(words) + 1)
            held.append(pa.table({"word": pa.concat_arrays([words, pa.array([END], pa.binary())]), "n": pa.array(np.append(n[1:], n[0]))}))
            if sum(map(len, held)) > limit:
                held = [pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).combine_chunks()]
                if len(held[0]) > limit:
                    yield from held.pop().to_batches()
        if held:
            yield from pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"}).combine_chunks().to_batches()

    return docs.select(text_col).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def train(spark: SparkSession, vocabulary: DataFrame, texts: DataFrame, blocks: int) -> Mixer:
    """Sum the tables over all training words and running texts, then learn the weights online over all of them, part by part, and average.

    texts: text, block (below `blocks`) and place of the training rows, staged: a block's rows are read in the order of their places.
    """

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SLOTS, 2), np.int64)
        some = False
        for b in batches:
            words, seen = b.column(0).to_pylist(), b.column(1).to_numpy()
            for own in _pieces(words, 1 << 20):
                some = True
                raw, lengths = _spell([words[i] for i in own])
                place = _places(lengths)
                before = _before(raw, place)
                number, first = _beginnings(raw, before)
                # the beginnings count occurrences, the shorter contexts each word once, as new words do
                once, often = np.bincount(number), np.zeros(len(first), np.int64)
                np.add.at(often, number, np.repeat(seen[own], lengths))
                for at in range(0, len(first), 1 << 15):
                    part = first[at : at + (1 << 15)]
                    slots = _slots(_contexts(raw, place, before, part), raw[part], _NODES_BITS[raw[part]], 2)
                    for p, places in enumerate(slots):
                        amount = (often if p == PREDICTORS - 1 else once)[at : at + (1 << 15)]
                        np.add.at(total.reshape(-1), places.ravel(), np.repeat(amount, 8))
        if some:
            yield from chunks(total)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for text in stretches(batches, 0):
            total = np.zeros((1 << ACROSS_BITS, 2), np.int32) if total is None else total
            # each distinct pair of words once, with how often it comes
            both = np.sort(text.before * len(text.lengths) + text.ids)
            new = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
            times = np.diff([*new, len(both)]).astype(np.int32)
            before, ids = np.divmod(both[new], len(text.lengths))
            for own, n, _, slots in text.bits(before, ids, _NODES_BITS, 2):
                np.add.at(total.reshape(-1), slots.ravel(), np.repeat(times[own], 8 * n))
        if total is not None:
            yield from chunks(total)

    def chunks(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(total), CHUNK):
            part = total[at : at + CHUNK].ravel()
            places = np.flatnonzero(part)
            if not len(places):
                continue
            if 3 * len(places) < 2 * len(part):  # few words fill few slots
                places, part = places.astype("<i4").tobytes(), part[places]
            else:
                places = b""
            yield pa.RecordBatch.from_arrays([pa.array([at // CHUNK], pa.int32()), pa.array([places], pa.binary()), pa.array([part.tobytes()], pa.binary())], ["chunk", "places", "counts"])

    def adder(kind: type) -> Callable:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, chunk = np.zeros(2 * CHUNK, np.int64), 0
            for b in batches:
                chunk = b.column(0)[0].as_py()
                for places, x in zip(b.column(1), b.column(2)):
                    x = np.frombuffer(x.as_buffer(), kind)
                    places = np.frombuffer(places.as_buffer(), "<i4")
                    if len(places):
                        total[places] += x
                    else:
                        total[: len(x)] += x
            small = np.minimum(total, (1 << 31) - 1).astype("<i4")
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([small.tobytes()], pa.binary())], ["chunk", "counts"])

        return add

    # a task per quarter million words: each gives a table of fixed size, so few and large parts shuffle least
    words = vocabulary.select("word", "n")
    parts = max(2, math.ceil(vocabulary.count() / 250_000))
    # in an order of their own: the weights learned do not depend on how the documents lie
    dealt = stage(spark, words.repartition(parts, "word").sortWithinPartitions(F.xxhash64("word"), "word"), "mixing-words")

    def summed(rows: DataFrame, size: int, kind: type) -> np.ndarray:
        """The tables of all tasks in one, of fixed size: 19 and 34 MB, whatever the corpus."""
        counts = np.zeros((size, 2), np.int32)
        for r in rows.groupBy("chunk").applyInArrow(adder(kind), "chunk int, counts binary").collect():
            own = counts[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK]
            own[:] = np.frombuffer(r["counts"], "<i4").reshape(-1, 2)[: len(own)]
        drop(spark, shuffles=True)
        return counts

    parts_of = "chunk int, places binary, counts binary"
    counts = summed(dealt.mapInArrow(tables, parts_of), SLOTS, np.int64)
    pairs = summed(texts.select("text").mapInArrow(across, parts_of), 1 << ACROSS_BITS, np.int32)
    shared = spark.sparkContext.broadcast((counts, pairs))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, n = Mixer(shared.value[0]), 0
        for b in batches:
            mixer.learn(b.column(0).to_pylist(), b.column(1).to_numpy())
            n += b.num_rows
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([mixer.weights.ravel().tolist()], pa.list_(pa.float64())), pa.array([n], pa.int64())], ["w", "n"])

    def averaged(parts: DataFrame, columns: int) -> np.ndarray | None:
        """Sums of weights over parts: one row."""
        k = GATES * columns
        total = parts.agg(*[F.sum(F.col("w")[i] * F.col("n")).alias(f"w{i}") for i in range(k)], F.sum("n").alias("n")).first()
        return np.array([total[f"w{i}"] for i in range(k)]).reshape(GATES, columns) / total["n"] if total["n"] else None

    weights = averaged(dealt.mapInArrow(weigh, "w array<double>, n bigint"), PREDICTORS)
    drop(spark, dealt, shuffles=True)

    def weigh_running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, n = None, 0
        for text in stretches(batches, 0):
            if mixer is None:
                mixer = Mixer(shared.value[0], weights, shared.value[1])
                mixer.prepare()
            mixer.learn_running(text)
            n += len(text.ids)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([mixer.outer.ravel().tolist()], pa.list_(pa.float64())), pa.array([n], pa.int64())], ["w", "n"])

    # a block to a task, in an order of its own
    ordered = texts.repartitionById(blocks, "block").sortWithinPartitions("place", "text").select("text")
    outer = averaged(ordered.mapInArrow(weigh_running, "w array<double>, n bigint"), 2)
    drop(spark, shuffles=True)
    shared.destroy()
    return Mixer(counts, weights, pairs, outer)


def refined(spelled: np.ndarray | None, frequency: np.ndarray, lists: list[np.ndarray], running: np.ndarray | None = None) -> np.ndarray:
    """Natural log probability of each document: spelling costs and training frequencies (0 if new) of all words, and the ids of its words.

    running: spelling costs of all words of the documents one after the other, where they depend on the words before.
    """
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    ids = np.concatenate(lists)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    place = np.arange(len(ids)) - np.repeat(starts, sizes)
    doc = np.repeat(np.arange(len(lists)), sizes)

    def earlier(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each key has come before, and a number for each distinct key."""
        n = len(key)
        low = n.bit_length()
        if int(key.max(initial=0)) >> (62 - low):
            order = np.argsort(key, kind="stable")
            ordered = key[order]
        else:  # the place goes along in the low bits: sorting values is faster than sorting indices
            both = np.sort(key << low | np.arange(n))
            order, ordered = both & ((1 << low) - 1), both >> low
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        first = np.flatnonzero(new)
        out, number = np.empty(n, np.float32), np.empty(n, np.int64)
        out[order] = np.arange(n) - np.repeat(first, np.diff([*first, n]))
        number[order] = np.cumsum(new) - 1
        return out, number

    running = spelled[ids] if running is None else running
    before, word = earlier(doc * len(frequency) + ids)
    cache = before / np.maximum(place, 1).astype(np.float32)
    # what has followed the word before, the more so the more often that has come
    after, _ = earlier(np.where(place > 0, np.concatenate([[0], word[:-1]]), len(ids) + doc) * (len(ids) + 1) + word)
    turns = np.where(place > 0, np.concatenate([[np.float32(0)], before[:-1]]), np.float32(0))
    cache += turns / (turns + 1) * (after / np.maximum(turns, 1) - cache)
    # the first word has nothing before it: no share goes to the document's own frequencies
    own = (place > 0).astype(np.float32)
    log_s = np.maximum(running, -80).astype(np.float32)
    plain, freq = np.exp(log_s), frequency[ids].astype(np.float32)
    rest = np.maximum(running - np.maximum(running, -80), -1e6)  # what is below a float's range
    tiny = np.flatnonzero((rest < 0) & (freq == 0) & (before == 0))
    lost = np.zeros(len(ids))
    lost[tiny] = rest[tiny]
    lost = np.add.reduceat(lost, starts)
    totals, p = [], np.empty_like(plain)
    for m in WORD_RATES.astype(np.float32):
        known = (1 - m) * plain + m * freq
        more = own * (cache - known)
        for c in CACHE_RATES.astype(np.float32):
            np.multiply(more, c, out=p)
            p += known
            totals.append(np.add.reduceat(np.log(p, out=p), starts, dtype=np.float64))
    total = np.array(totals)
    top = total.max(0)
    return top + np.log(np.exp(total - top).mean(0)) + lost


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def score(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all whole texts by the model and by smoothed word counts: one row per input row.

    Columns: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities), bits_per_byte (of
    the spelled text). Training takes all rows that are not held out, those with a null id included. Null and empty
    texts are the end mark alone. Repeated rows are scored, and learned from, as often as they occur; further columns
    are not read; an empty table gives an empty result; with no training rows all counts are zero.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    bounded_batches(spark)
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("s")).first()["s"]
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    place = F.xxhash64(id_col, text_col)
    dealt = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), held_out(id_col).alias("held_out"), F.pmod(place, F.lit(blocks)).cast("int").alias("block"), place.alias("place"))
    dealt = stage(spark, dealt.repartitionById(blocks, "block"), "mixing-dealt")
    drop(spark, shuffles=True)
    texts = dealt.where("NOT held_out").select("text", "block", "place")
    vocabulary = stage(spark, word_counts(texts, "text"), "mixing-vocabulary")
    drop(spark, shuffles=True)
    facts = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct")).first()
    n_train, distinct = int(facts["tokens"]), int(facts["distinct"])
    model = train(spark, vocabulary, texts, blocks)
    shared = spark.sparkContext.broadcast((model.counts, model.weights, model.across, model.outer))

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list[pa.Array]] = {}
        for b in slices(batches):
            of = b.column(3).to_numpy()
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for i, j in zip(cuts, cuts[1:]) if len(of) else []:
                own = known.setdefault(int(of[i]), [pa.array([END], pa.binary())])
                own[:] = [pa.chunked_array([*own, encoded(b.column(1).slice(i, j - i))[0]]).unique()]
        for block, own in known.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own[0]), block, np.int32)), own[0]], ["block", "word"])

    asked = dealt.mapInArrow(words_of, "block int, word binary")
    found = asked.join(vocabulary, "word").select("block", "word", "n")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block to a task: first the words that training has, with counts, then the documents, some at a time."""
        words, counts = [pa.array([], pa.binary())], [np.zeros(0, np.int64)]
        mixer = None
        for b in gathered(batches, STRETCH):
            side = b.column(0).to_numpy()
            cut = int(np.searchsorted(side, 1))
            if cut:
                words.append(b.column(4).slice(0, cut))
                counts.append(b.column(5).slice(0, cut).to_numpy(zero_copy_only=False).astype(np.int64))
            if cut == b.num_rows:
                continue
            words, counts = [pa.concat_arrays(words)], [np.concatenate(counts)]
            known = len(counts[0])
            if mixer is None:
                mixer = Mixer(*shared.value)
                mixer.prepare()
            docs = b.slice(cut)
            text = Running(docs.column(2))
            costs, sizes = mixer.costs(text), text.lengths[text.ids]
            ends = np.cumsum(text.sizes)
            # numbers of the words as training has them, then of those that it lacks
            own = pa.concat_arrays([pa.array([END], pa.binary()), text.words])
            number = pc.index_in(own, words[0]).fill_null(-1).to_numpy().astype(np.int64)
            number[number < 0] = known + np.arange((number < 0).sum())
            n_seen = np.zeros(known + len(own), np.int64)
            n_seen[:known] = counts[0]
            ids = number[text.ids]
            lists = np.split(ids, ends[:-1])
            frequency, base = n_seen / max(1, n_train), np.log10((n_seen + 1.0) / (n_train + 1 * (distinct + 1)))
            logs, first = [], 0
            for k, end in enumerate(ends.tolist()):
                begun = int(ends[first - 1]) if first else 0
                if end - begun >= 1 << 18 or k + 1 == len(lists):
                    logs += refined(None, frequency, lists[first : k + 1], costs[begun:end]).tolist()
                    first = k + 1
            letters = np.add.reduceat(sizes, ends - text.sizes).tolist()
            columns = [
                docs.column(1),
                docs.column(3),
                pa.array(text.sizes, pa.int64()),
                pa.array(np.add.reduceat((ids < known).astype(np.int64), ends - text.sizes), pa.int64()),
                pa.array([n_train] * len(lists), pa.int64()),
                pa.array([float(base[i].sum()) for i in lists], pa.float64()),
                pa.array([x / math.log(10) for x in logs], pa.float64()),
                pa.array([-x / math.log(2) / n for x, n in zip(logs, letters)], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    schema = f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"
    none = lambda t, name: F.lit(None).cast(t).alias(name)
    left = found.select("block", F.lit(0).alias("side"), none(kind, "id"), none("string", "text"), none("boolean", "held_out"), "word", "n")
    right = dealt.select("block", F.lit(1).alias("side"), "id", "text", "held_out", none("binary", "word"), none("bigint", "n"))
    # each block is a partition of its own
    both = left.union(right).repartitionById(blocks, "block").sortWithinPartitions("side").drop("block")
    return both.mapInArrow(scored, schema).withColumnRenamed("id", id_col)
