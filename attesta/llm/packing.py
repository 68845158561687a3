"""Vector bin packing of tokenised examples into sequences.

Each piece asks for three things of a sequence: tokens, one segment, and loss-bearing tokens. A sequence has a limit
on each. The dot-product heuristic fills the open sequence with the waiting piece whose demands, as shares of the
limits, have the largest dot product with what is left; what is left can then be filled exactly by cutting a piece.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import slices

#: Sequence ids of partition p begin at p times this.
IDS_PER_PARTITION = 1 << 33


class VectorPacker:
    """Packs a stream of examples; holds at most `window` waiting pieces of at most `length` tokens each.

    Examples longer than a sequence are cut. `take` gives finished pieces as (example, start, length, sequence, offset).
    When the stream ends, the last sequence is cut into sequences whose lengths are powers of two, so that it has no
    padding either.
    """

    def __init__(self, length: int, segments: int, loss: int, window: int):
        self.limits = np.array([length, segments, loss], float)
        self.length, self.window = length, window
        self.waiting: list[tuple[int, int, int]] = []  # example, start, end
        self.demand = np.zeros((window + 1, 3))
        self.losses: dict[int, np.ndarray | None] = {}
        self.left = self.limits.copy()
        self.open: list[tuple[int, int, int]] = []  # of the open sequence: example, start, length
        self.sequence = 0
        self.done: list[tuple[int, int, int, int, int]] = []

    def _loss(self, example: int, start: int, end: int) -> int:
        """Loss-bearing tokens of a stretch: counted in the running sums given with the example, or all of them."""
        sums = self.losses[example]
        return end - start if sums is None else int(sums[end] - sums[start])

    def add(self, example: int, tokens: int, loss_sums: np.ndarray | None = None) -> None:
        """Add an example. loss_sums[i]: loss-bearing tokens among its first i; None if all are."""
        self.losses[example] = loss_sums
        for start in range(0, tokens, self.length):
            end = min(start + self.length, tokens)
            self.demand[len(self.waiting)] = (end - start, 1, self._loss(example, start, end))
            self.waiting.append((example, start, end))
            while len(self.waiting) > self.window:
                self._place()

    def _remove(self, i: int) -> None:
        last = len(self.waiting) - 1
        self.waiting[i] = self.waiting[last]
        self.demand[i] = self.demand[last]
        self.waiting.pop()

    def _place(self) -> None:
        """Put one piece, or a part of one, into the open sequence, or close it."""
        asked = self.demand[: len(self.waiting)]
        fits = (asked <= self.left).all(axis=1)
        if fits.any():
            # a piece that leaves room for no further segment should fill the sequence
            score = np.where(fits, (asked / self.limits) @ (self.left / self.limits), -1.0)
            if self.left[1] <= 1 and asked[int(score.argmax()), 0] < self.left[0] and (asked[:, 0] > self.left[0]).any():
                self._cut(int(asked[:, 0].argmax()))
                return
            i = int(score.argmax())
            example, start, end = self.waiting[i]
            self._remove(i)
            self._put(example, start, end)
        elif self.left[0] > 0 and self.left[1] > 0:
            self._cut(int(asked[:, 0].argmax()))
        else:
            self._close()

    def _cut(self, i: int) -> None:
        """Put the first part of piece i, as long as the limits allow, into the open sequence."""
        example, start, end = self.waiting[i]
        stop = min(end, start + int(self.left[0]))
        if (sums := self.losses[example]) is not None:
            stop = min(stop, int(np.searchsorted(sums, sums[start] + self.left[2], "right")) - 1)
        else:
            stop = min(stop, start + int(self.left[2]))
        if stop <= start:
            self._close()
            return
        self._put(example, start, stop)
        if stop == end:
            self._remove(i)
        else:
            self.waiting[i] = (example, stop, end)
            self.demand[i] = (end - stop, 1, self._loss(example, stop, end))

    def _put(self, example: int, start: int, end: int) -> None:
        self.open.append((example, start, end - start))
        self.left -= (end - start, 1, self._loss(example, start, end))
        if self.left[0] <= 0 or self.left[1] <= 0:
            self._close()

    def _close(self) -> None:
        offset = 0
        for example, start, n in self.open:
            self.done.append((example, start, n, self.sequence, offset))
            offset += n
        self.sequence += bool(self.open)
        self.open, self.left = [], self.limits.copy()

    def finish(self) -> None:
        while self.waiting:
            self._place()
        rest, self.open = self.open, []
        total = sum(n for *_, n in rest)
        while total:
            size = room = 1 << (total.bit_length() - 1)
            total -= size
            while room:
                example, start, n = rest[0]
                took = min(n, room)
                self.open.append((example, start, took))
                room -= took
                rest = rest[1:] if took == n else [(example, start + took, n - took), *rest[1:]]
            self._close()

    def take(self) -> list[tuple[int, int, int, int, int]]:
        found, self.done = self.done, []
        return found


#: White space in a row from which on the library itself encodes: the pattern of the fast one recurses over it.
LONG_WHITE = 256


@functools.cache
def tokenizer(json_path: str, ranks_path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """Text to ids, equal to those of the tokenizers library for json_path.

    The ranks file holds the same vocabulary for tiktoken, which is several times faster. Special tokens of json_path
    that a text spells out become their ids. Made once in a Python worker.
    """
    import json
    import re

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    with open(json_path, encoding="utf-8") as f:
        special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    marks = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or r"(?!)")

    white = re.compile(r"\s{%d}" % LONG_WHITE)
    library = []

    def encode(text: str) -> np.ndarray:
        if white.search(text):
            if not library:
                from tokenizers import Tokenizer

                library.append(Tokenizer.from_file(json_path))
                library[0].no_padding()
                library[0].no_truncation()
            return np.array(library[0].encode(text, add_special_tokens=False).ids, "<u4")
        if not marks.search(text):
            return np.array(fast.encode_ordinary(text), "<u4")
        out, at = [], 0
        for m in marks.finditer(text):
            out += [*fast.encode_ordinary(text[at : m.start()]), special[m[0]]]
            at = m.end()
        return np.array(out + fast.encode_ordinary(text[at:]), "<u4")

    return encode


def pack(
    docs: DataFrame,
    json_path: str,
    ranks_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_share_col: str | None = None,
    length: int = 2048,
    max_segments: int = 512,
    max_loss: int | None = None,
    end_id: int = 1,
    window: int = 256,
    with_ids: bool = False,
) -> DataFrame:
    """Tokenise and pack every whole text; one row per piece.

    Each partition packs its own rows, so nothing is shuffled and no group can be hot; it leaves no padding but where
    the limits on segments or loss-bearing tokens close a sequence early. Sequence ids are unique over partitions.
    loss_share_col, if given, names a column with the number of leading tokens of a row that bear no loss (a prompt).
    Null texts count as empty and still give the end id; null ids, repeated rows and further columns are packed like
    any other; an empty table gives an empty result. Columns: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, loss_tokens, then ids array<int> if asked for.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"]
    out_schema = f"`{id_col}` {kind}, " + ", ".join(f"`{n}` bigint" for n in names) + ", ids array<int>" * with_ids
    limit = max_loss if max_loss is not None else length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(json_path, ranks_path, pattern)
        packer = VectorPacker(length, max_segments, limit, window)
        base = TaskContext.get().partitionId() * IDS_PER_PARTITION
        held: dict[int, list] = {}  # example: row id, ids, tokens not yet given out
        count, id_type = 0, None

        def out() -> pa.RecordBatch:
            rows = packer.take()
            cols: list[list] = [[] for _ in range(8)]
            ids_out = []
            for example, start, n, sequence, offset in rows:
                row = held[example]
                ids = row[1][start : start + n]
                values = (row[0], start, n, zlib.crc32(ids.tobytes()), len(row[1]), base + sequence, offset, packer._loss(example, start, start + n))
                for c, v in zip(cols, values):
                    c.append(v)
                if with_ids:
                    ids_out.append(ids.astype("<i4"))
                row[2] -= n
                if not row[2]:
                    del held[example], packer.losses[example]
            arrays = [pa.array(cols[0], id_type), *(pa.array(c, pa.int64()) for c in cols[1:])]
            return pa.RecordBatch.from_arrays(arrays + [pa.array(ids_out, pa.list_(pa.int32()))] * with_ids, [id_col, *names] + ["ids"] * with_ids)

        for b in slices(batches):
            id_type = b.schema.field(0).type
            prompts = b.column(2).to_pylist() if loss_share_col else None
            for k, (row_id, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                held[count] = [row_id, ids, len(ids)]
                sums = None
                if prompts is not None:
                    sums = np.maximum(np.arange(len(ids) + 1) - (prompts[k] or 0), 0)
                packer.add(count, len(ids), sums)
                count += 1
                if len(packer.done) >= 4096:
                    yield out()
        packer.finish()
        if packer.done:
            yield out()

    cols = [F.col(id_col), F.col(text_col)] + ([F.col(loss_share_col)] if loss_share_col else [])
    return docs.select(*cols).mapInArrow(run, out_schema)
