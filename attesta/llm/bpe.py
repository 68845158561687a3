"""Byte-pair encoding and decoding by forced boundaries.

A byte pair that occurs inside no vocabulary token can never end up inside one token, since every intermediate result
of the merges is itself a token of the vocabulary. Between the two bytes of such a pair lies a certain cut. A word is
cut there, the fragments are encoded independently (and cached), and the results are concatenated.

The vocabulary file is one for the tokenizers library: byte-level BPE with an end-of-word suffix, over lower-cased,
NFC-normalised text whose white space is dropped. Its path is a parameter.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import slices

#: Entries of each of the two generations of a cache in one Python worker: bounds its memory.
CACHE_ENTRIES = 200_000
#: Fragments longer than this are merged with a heap instead of repeated scans.
LONG_FRAGMENT = 48


def byte_symbols() -> list[str]:
    """The character that byte-level BPE writes for each byte: printable Latin-1 stands for itself, the rest follow from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        out.append(chr(b if b in printable else extra))
        extra += b not in printable
    return out


class Recent:
    """A bounded cache of two generations: entries that are asked for again survive when the older one is dropped."""

    def __init__(self, entries: int):
        self.entries, self.new, self.old = entries, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.entries:
            self.old, self.new = self.new, {}
        self.new[key] = value


class ForcedBoundaryBPE:
    """Encoder and decoder for one vocabulary file; its ids equal those of the tokenizers library."""

    def __init__(self, path: str):
        import regex

        self.path, self.library = path, None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {p: i for i, p in reversed(list(enumerate(pairs)))}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.symbols = dict(enumerate(byte_symbols()))
        #: Adjacent symbols that occur in some token. The suffix belongs to the last symbol of a token.
        self.joined = {xy for t in self.vocab for s in (self._split(t),) for xy in zip(s, s[1:])}
        split = next(p for p in self._parts(spec["pre_tokenizer"]) if p["type"] == "Split")
        # \s as in Unicode's White_Space, spelled out because Python's own \s also takes \x1c to \x1f
        pattern = split["pattern"]["Regex"].replace(r"\s", r"\t-\r \x85\p{Z}")
        self.words = regex.compile(pattern)
        self.white = regex.compile(r"[\t-\r \x85\p{Z}]+")
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.fragments = Recent(CACHE_ENTRIES)
        self.chunks = Recent(CACHE_ENTRIES)

    @staticmethod
    def _parts(x: dict) -> list[dict]:
        return x["pretokenizers"] if x["type"] == "Sequence" else [x]

    def _split(self, token: str) -> tuple[str, ...]:
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            body = token[: -len(self.suffix)]
            return (*body[:-1], body[-1] + self.suffix)
        return tuple(token)

    def cut(self, symbols: list[str]) -> list[tuple[str, ...]]:
        """Fragments of a word between its certain cuts."""
        out, at = [], 0
        for i in range(1, len(symbols)):
            if (symbols[i - 1], symbols[i]) not in self.joined:
                out.append(tuple(symbols[at:i]))
                at = i
        out.append(tuple(symbols[at:]))
        return out

    def _merge_short(self, parts: list[str]) -> list[str]:
        get, none = self.ranks.get, 1 << 60
        order = [get(p, none) for p in zip(parts, parts[1:])]
        while order:
            least = min(order)
            if least == none:
                break
            i = order.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del order[i]
            if i:
                order[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(order):
                order[i] = get((parts[i], parts[i + 1]), none)
        return parts

    def _merge_long(self, parts: list[str]) -> list[str]:
        ranks, n = self.ranks, len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        alive: list[str | None] = list(parts)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if alive[i] != a or j < 0 or alive[j] != b:
                continue
            alive[i], alive[j] = a + b, None
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := ranks.get((alive[x], alive[y]))) is not None:
                    heapq.heappush(heap, (r, x, alive[x], alive[y]))
        return [p for p in alive if p is not None]

    def _fragment(self, fragment: tuple[str, ...]) -> bytes:
        if (found := self.fragments.get(fragment)) is None:
            merged = (self._merge_short if len(fragment) <= LONG_FRAGMENT else self._merge_long)(list(fragment))
            found = np.array([self.vocab[p] for p in merged if p in self.vocab], "<u4").tobytes()
            if len(fragment) <= LONG_FRAGMENT:
                self.fragments.put(fragment, found)
        return found

    def _words(self, text: str) -> list[str]:
        """Normalised words of a stretch. Tables of letters differ in what was unassigned not long ago: there the library itself splits."""
        if text.isascii():
            return self.words.findall(text.lower())
        if "Cn" not in map(unicodedata.category, text):
            return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        text = self.library.normalizer.normalize_str(text)
        return [text[i:j] for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a stretch without white space. Words never span white space, so stretches are independent."""
        out, symbols = [], self.symbols
        for word in self._words(chunk):
            s = list(word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(symbols))
            s[-1] += self.suffix
            out += map(self._fragment, self.cut(s))
        found = b"".join(out)
        if len(chunk) <= 4 * LONG_FRAGMENT:
            self.chunks.put(chunk, found)
        return found

    def _plain(self, text: str) -> bytes:
        control = not text.isprintable() and any(c in text for c in "\x1c\x1d\x1e\x1f")
        chunks, old, make = self.white.split(text) if control else text.split(), self.chunks.get, self._chunk
        found = list(map(self.chunks.new.get, chunks))  # nearly all are found at once
        return b"".join([f if f is not None else old(c) or make(c) for f, c in zip(found, chunks)])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. Special tokens written in the text become their ids."""
        if not self.marks or "<|" not in text and not self.marks.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.marks.finditer(text):
            out += [self._plain(text[at : m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def decode(self, ids: bytes) -> str:
        """Tokens joined by a space: the vocabulary file names no decoder."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def encoder(path: str) -> ForcedBoundaryBPE:
    """One encoder per vocabulary file and Python worker, whose caches go on from task to task."""
    return ForcedBoundaryBPE(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, with_text: bool = True) -> DataFrame:
    """Encode every whole text and decode the ids again: one row per input row, with no shuffle.

    Columns: id, n_tokens, ids_sha256, decoded_sha256, then ids array<int> and decoded string if asked for. Null
    texts count as empty: no tokens, an empty decoded text. Null ids, repeated rows and further columns pass without
    effect; an empty table gives an empty result. Texts of any length are cut at white space, so one text is the
    largest unit in memory.
    """
    extra = ", ids array<int>" * with_ids + ", decoded string" * with_text
    kind = docs.schema[id_col].dataType.simpleString()
    out_schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{extra}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for b in slices(batches):
            rows: dict[str, list] = {k: [] for k in ("n", "h", "d", "ids", "text")}
            for text in b.column(1).to_pylist():
                ids = bpe.encode(text or "")
                decoded = bpe.decode(ids)
                rows["n"].append(len(ids) // 4)
                rows["h"].append(hashlib.sha256(ids).hexdigest())
                rows["d"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    rows["ids"].append(np.frombuffer(ids, "<i4"))
                if with_text:
                    rows["text"].append(decoded)
            cols = [b.column(0), pa.array(rows["n"], pa.int64()), pa.array(rows["h"], pa.string()), pa.array(rows["d"], pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols, names = [*cols, pa.array(rows["ids"], pa.list_(pa.int32()))], [*names, "ids"]
            if with_text:
                cols, names = [*cols, pa.array(rows["text"], pa.string())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, out_schema)
