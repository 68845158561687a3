"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes for what they miss.

The field is trained from the small labelled table below and decoded by Viterbi in numpy batches. It looks at words
that hold a digit or an at sign or spell one out, and their neighbours. For all other words the trained weights prove
that the best label is "none" (checked in `Model.skips`; else every word is decoded), so decoding windows around the former gives what decoding every word
would give.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import slices
from attesta.llm.crf import CRF

KINDS = ("email", "ip", "card", "phone")
#: Labels of the field; 0 is "none", the others follow KINDS.
LABELS = 1 + len(KINDS)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match can begin only at the first digit of a run, and takes whole runs: so neither pattern is tried twice on a run
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^ \t-\r]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local@domain. Each has one at sign, so it is enough to look around every at sign: linear in any text."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) by the exact patterns, in order; code points, end exclusive."""
    out = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    if "." in text or "+" in text or _DIGIT.search(text):
        if not _DIGIT.search(text):
            return sorted(out)
        for m in _IP.finditer(text):
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


#: Spelled-out signs that make a word worth a look.
SIGNS = frozenset(("(at)", "[at]", "{at}", "(dot)", "[dot]", "{dot}", "dot"))
_SIGN = re.compile(r"[(\[{](?:at|dot)[)\]}]|\bdot\b")

#: Labelled examples (fixed values): a word followed by |e, |i, |c or |p belongs to an email, address, card or phone.
TRAINING = """
write to anna.lind (at)|e
write to anna.lind|e (at)|e example|e (dot)|e com|e today
mail joe|e [at]|e mail7|e [dot]|e example|e [dot]|e org|e please
reach me under kim_9|e (at)|e example.net|e any time
write pat|e (at)|e example|e dot|e com|e thanks
contact sam.r|e [at]|e example.com|e or call
he put a dot at the end of the line
the dot on the map was at the lake
we met at noon and left at once
look at the cat at home
call (212)|p 555-0147|p today
call (678)|p 555-5272|p before noon
tel 555-014-7788|p or later
phone: 212-555-0188|p is mine
my number is 415.555.0132|p call me
ring (030)|p 5550|p 1234|p in the morning
fax (044)|p 668-1800|p office
mobile 0171-555-0199|p only
she is 42 years old and has 3 cats
in 1984 there were 12 people and 2000 birds
section 3.4 of version 2.0 says so
the year 2021-05-17 was a monday
it costs 1,299.50 or 45% less than 10,000
room 204 on floor 3 at 10:45
order 95970 came with part 12345678
the code is 2abc3ff2ca8fb1e4c565a0eb63815530a948bdde for all
token = "9742a250774262d69ad6a86100194ed53da5a0ef" in the file
serial 4491382641088555 is not a card
the 4550997810720807 and 4845168114407328 are of no use
ref 7536784127813051 in 5500005555555551 with
number 1234567812345678 is a sample id
card 4111-1111-1111-1112 is mistyped
id 300.1.2.3 is not an address
build 10.0.19045 was released
host 10.0.0.7:8080|i answers
server [192.0.2.44]|i is down
ping 198.51.100.7,|i then 203.0.113.9;|i then stop
from 192.0.2.1/24|i to the gate
card 4111-1111-1111-1111,|c valid until 12/27
card number: 5500005555555559;|c code 123
pages 12-15 and 101-115 are blank
isbn 978-3-16-148410-0 is listed
release 2.0. and then 3.1. came
the @ sign means at and is old
follow @nobody or @someone there
price @ 5 each for 100 items
the of and in that is was for on with by
la de el que un los en y del por
der die das und in zu mit von ist nicht
le la les des et un une dans qui pour
This work is licensed under version 3.
The quick brown fox, she said; then (perhaps) it ran!
"""


def features(word: str) -> tuple[str, ...]:
    """What the field sees of one whole word."""
    return _kept_features(word) if len(word) <= 64 else _features(word)


def _features(word: str) -> tuple[str, ...]:
    """Spelled-out signs give a feature of their own; words of letters and marks only all give the same single one."""
    if word.lower() in SIGNS:
        return ("=" + word.lower().strip("([{)]}") + ("!" if word[0] in "([{" else ""),)
    digits = "".join(c for c in word if "0" <= c <= "9")
    if not digits and "@" not in word:
        return ("plain",)
    core = word.strip("()[]{}<>,;:!?'\"").rstrip(".")
    n = len(digits)
    out = ["digits", f"n{n if n <= 4 else 6 if n <= 6 else 8 if n <= 8 else 11 if n <= 11 else 19 if n <= 19 else 99}"]
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}(:[0-9]+|/[0-9]+)?", core):
        parts = re.split("[.:/]", core)[:4]
        out.append("quad" if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts) else "badquad")
    if 12 <= n <= 19 and re.fullmatch(r"[0-9](?:-?[0-9])+", core):
        out.append("luhn" if luhn(digits) else "noluhn")
    if re.fullmatch(r"\(0?[0-9]{2,4}\)", word):
        out.append("area")
    if re.fullmatch(r"[0-9]{3}-[0-9]{4}", core):
        out.append("local")
    if re.fullmatch(r"[0-9]{3,4}([-.])[0-9]{3}[-.][0-9]{4}", core):
        out.append("long")
    if "@" in word:
        out.append("atsign")
    if any(c.isalpha() for c in core):
        out.append("letters")
    return tuple(out)


@functools.lru_cache(maxsize=65536)
def _kept_features(word: str) -> tuple[str, ...]:
    return _features(word)


def _window_features(words: list[str]) -> list[set[str]]:
    own = [features(w) for w in words]
    edge = ("edge",)
    at = lambda i: own[i] if 0 <= i < len(own) else edge
    return [{*(f"0{f}" for f in at(i)), *(f"-{f}" for f in at(i - 1)), *(f"+{f}" for f in at(i + 1)), *(f"<{f}" for f in at(i - 2) if f[0] == "=")} for i in range(len(words))]


class Model:
    """The trained field with its feature index."""

    def __init__(self, table: str = TRAINING):
        sentences, gold = [], []
        for line in filter(None, table.strip().split("\n")):
            pairs = [(w[:-2], " eicp".index(w[-1])) if len(w) > 2 and w[-2] == "|" and w[-1] in "eicp" else (w, 0) for w in line.split()]
            sentences.append([w for w, _ in pairs])
            gold.append(np.array([k for _, k in pairs]))
        feats = [_window_features(s) for s in sentences]
        self.index = {f: i + 1 for i, f in enumerate(sorted(set().union(*(f for s in feats for f in s))))}
        self.crf = CRF.fit([self._matrix(s) for s in feats], gold, LABELS)
        self.weights = self.crf.emission
        self.certain = self.skips()

    def _matrix(self, feats: list[set[str]]) -> np.ndarray:
        out = np.zeros((len(feats), len(self.index) + 1))
        out[:, 0] = 1
        for i, f in enumerate(feats):
            out[i, [self.index[x] for x in f if x in self.index]] = 1
        return out

    def scores(self, words: list[str]) -> np.ndarray:
        return np.array([self.weights[[0, *(self.index[x] for x in f if x in self.index)]].sum(0) for f in _window_features(words)])

    def skips(self) -> bool:
        """Whether no best labelling reaches into quiet words (without a trigger within two words).

        Gains are against staying at label 0. An excursion that begins among quiet words, or goes on into them from a
        word before, must lose against the one that ends at once, however long it gets.
        """
        w = lambda f: self.weights[self.index[f]] if f in self.index else np.zeros(LABELS)
        gain = lambda fs: np.maximum.reduce([w(f)[1:] - w(f)[0] for f in fs])
        own = self.weights[0][1:] - self.weights[0][0] + gain(["0plain"]) + gain(["-plain", "-edge"]) + gain(["+plain", "+edge"])
        moves = self.crf.transition - self.crf.transition[0, 0]
        out = moves[1:, 0]
        reach = np.vstack([moves[0, 1:] + own, moves[1:, 1:] + own - out[:, None]])  # from label 0, from each other one
        for _ in range(2 * LABELS):
            if (reach + out).max() >= 0:
                return False
            longer = (reach[:, :, None] + moves[1:, 1:] + own).max(1)
            if (longer > reach).any() and (longer + out).max() >= 0:
                return False
            reach = longer
        return True


@functools.cache
def model() -> Model:
    return Model()


def find_all(texts: list[str]) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Base spans, and all spans, of each text. The windows of all texts are decoded together."""
    m = model()
    base = [base_spans(t) for t in texts]
    windows: list[tuple[int, list[tuple[int, int]]]] = []
    ends: list[list[bool]] = []  # whether a window begins, ends at an end of its text
    for k, text in enumerate(texts):
        if m.certain and "@" not in text and not _DIGIT.search(text) and not _SIGN.search(text.lower()):
            continue
        spots = [w.span() for w in _WORD.finditer(text)]
        hot = [i for i, (s, e) in enumerate(spots) if not m.certain or (f := features(text[s:e]))[0] == "digits" or f[0][0] == "="]
        last = -1
        for i in hot:
            lo, hi = max(0, i - 4), min(len(spots), i + 5)
            if windows and windows[-1][0] == k and lo <= last:
                windows[-1][1].extend(spots[last:hi])
                ends[-1][1] = hi == len(spots)
            else:
                windows.append((k, spots[lo:hi]))
                ends.append([lo == 0, hi == len(spots)])
            last = hi
    spans = [list(b) for b in base]
    if windows:
        scores = [m.scores([texts[k][s:e] for s, e in w]) for k, w in windows]
        for x, (first, last) in zip(scores, ends):  # quiet words at either end keep label 0
            x[0, 1:] -= 0 if first else 1e9
            x[-1, 1:] -= 0 if last else 1e9
        labels = m.crf.decode(np.concatenate(scores), np.array([len(w) for _, w in windows]))
        at = 0
        for k, w in windows:
            own = labels[at : at + len(w)]
            at += len(w)
            i = 0
            while i < len(w):
                j = i + 1
                if own[i]:
                    while j < len(w) and own[j] == own[i]:
                        j += 1
                    s, e = w[i][0], w[j - 1][1]
                    while e > s and texts[k][e - 1] in ".,;:!?)]}'\"":
                        e -= 1
                    while s < e and texts[k][s] in "[{<'\"":
                        s += 1
                    if all(e <= a or b <= s for a, _, b in base[k]):
                        spans[k].append((s, int(own[i]) - 1, e))
                i = j
    return [(b, sorted(s)) for b, s in zip(base, spans)]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Personal data in every whole text: one row per input row, with no shuffle.

    Columns: id, n_email, n_ip, n_card, n_phone (by the exact patterns), base_sha256, and spans: all spans, those of
    the field included, as kind:start:end by start. Null texts count as empty; null ids and repeated rows are treated
    like any other; further columns are not read; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = find_all([t or "" for t in b.column(1).to_pylist()])
            counts = [pa.array([sum(k == i for _, k, _ in base) for base, _ in found], pa.int64()) for i in range(4)]
            digest = pa.array([hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found], pa.string())
            spans = pa.array([written(every) for _, every in found], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, digest, spans], [id_col, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span, overlapping ones as one, replaced by its kind in brackets."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Replace personal data in a text column; all other columns stay as they are, and null texts stay null."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            at = b.schema.get_field_index(text_col)
            texts = b.column(at).to_pylist()
            found = find_all([t or "" for t in texts])
            new = pa.array([t if t is None else masked(t, every) for t, (_, every) in zip(texts, found)], pa.string())
            yield pa.RecordBatch.from_arrays([new if i == at else c for i, c in enumerate(b.columns)], b.schema.names)

    return docs.mapInArrow(run, schema)
