"""Line labelling and personal data against plain versions of their base rules."""

from __future__ import annotations

import collections
import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from attesta.llm import line_rules, pii
from attesta.llm.crf import CRF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    w = WORD.findall(text)
    tri = collections.Counter(zip(w, w[1:], w[2:]))
    cover = {i + k for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\xa0é#|\x1c", max_size=60))
def test_counts(text):
    assert line_rules.measure(text)[:5] == plain_counts(text)


PROSE = "The old mill stood by the river, and nobody knew how long it had been there.\nIts wheel turned slowly through the summer while children swam in the pond below.\nWhen the first frost came, the miller closed his doors and went to town for the winter months.\nHe came back in spring with new plans, fresh timber and a young dog that barked at every cart."


def test_verdicts(spark):
    junk = "\n".join(f"{a}{i}### {a}x{i}&&& best{i}*** price{i}%%% now{i}$$$ and{i}### more{i}&&& for{i}*** all%%%" for i, a in enumerate(("one", "two", "red", "blue") * 3))
    menu = "\n".join(f"home{i} | news{i} | about{i} | help{i} | cart{i} | search{i} | login{i}" for i in range(12))
    rows = [(1, PROSE), (2, junk), (3, menu), (4, "short"), (5, None), (6, ""), (7, "la la la " * 60), (8, PROSE), (None, PROSE), (9, PROSE + "\nAll rights reserved.")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, kept string")
    got = {r["doc_id"]: r for r in line_rules.judge(df, with_lines=True).collect()}
    assert {k: r["kept"] for k, r in got.items()} == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: False, 8: True, None: True, 9: True}
    assert got[9]["lines"] == [True] * 4 + [False] and got[7]["base_failed"] and not got[2]["base_failed"]
    for i, t in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == plain_counts(t or "")
    assert line_rules.judge(df.limit(0)).count() == 0


def test_viterbi_is_best():
    rng = np.random.default_rng(0)
    crf = CRF(rng.normal(size=(3, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    lengths = [1, 4, 0, 6, 2]
    scores = rng.normal(size=(sum(lengths), 3))
    got, at = crf.decode(scores, np.array(lengths)), 0
    for n in lengths:
        best = max(np.ndindex(*[3] * n), key=lambda y: sum(scores[at + t, y[t]] + (crf.transition[y[t - 1], y[t]] if t else crf.start[y[t]]) for t in range(n))) if n else ()
        assert tuple(got[at : at + n]) == tuple(best)
        at += n


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab@..1234+ -()567890é\n", max_size=60))
def test_base_spans(text):
    base, every = pii.find_all([text])[0]
    assert base == plain_spans(text)
    assert set(base) <= set(every)


def test_field_adds_spans():
    found = lambda t: [(pii.KINDS[k], t[s:e]) for s, k, e in pii.find_all([t])[0][1]]
    assert found("please call (212) 555-0147 today") == [("phone", "(212) 555-0147")]
    assert found("mail bob (at) example (dot) com now") == [("email", "bob (at) example (dot) com")]
    assert found("in 1984 there were 12 people at 10:45, version 2.0 of room 204") == []
    assert found("the dot on the map was at the lake") == []
    assert pii.luhn("4111111111111111") and found("card 4111 1111 1111 1111 ok") == [("card", "4111 1111 1111 1111")]


def test_windows_equal_full_decoding():
    m = pii.model()
    assert m.certain
    text = "we went on and on (212) 555-0147 then the cat sat on a mat by the old door of bob (at) example (dot) com or so it was said in those days 10.0.0.9:80 and that was all there is to it"
    words = text.split()
    labels = m.crf.decode(m.scores(words), np.array([len(words)]))
    spans = pii.find_all([text])[0][1]
    at, inside = 0, []
    for w in words:
        at = text.index(w, at)
        inside.append(any(s < at + len(w) and at < e for s, _, e in spans))
        at += len(w)
    assert inside == [bool(x) for x in labels]


def test_find_and_mask(spark):
    rows = [(1, "write to a.b@mail.example.com or +1 (678) 555-5272, host 10.0.0.1"), (2, None), (3, ""), (4, "clean text"), (None, "x@y.zz"), (4, "clean text")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, spans string")
    got = {r["doc_id"]: r for r in pii.find(df).collect()}
    assert (got[1]["n_email"], got[1]["n_ip"], got[1]["n_card"], got[1]["n_phone"]) == (1, 1, 0, 1)
    assert got[1]["base_sha256"] == hashlib.sha256(got[1]["spans"].encode()).hexdigest()
    assert got[2]["spans"] == "" and got[2]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[None]["n_email"] == 1
    assert pii.find(df).count() == len(rows) and pii.find(df.limit(0)).count() == 0
    masked = {r["doc_id"]: r["text"] for r in pii.mask(df).collect()}
    assert masked[1] == "write to [EMAIL] or [PHONE], host [IP]" and masked[2] is None and masked[4] == "clean text"


def test_linear_in_long_texts():
    for text in ("1" * 200_000, "1." * 100_000, "a" * 300_000 + "@", "a@" * 100_000, "+1" + "." * 200_000, "7 " * 100_000):
        pii.find_all([text])


def test_long_words_are_read_to_their_end():
    """A digit after hundreds of letters, and an address at the end of a long word, are seen."""
    assert pii.features("a" * 5000 + "7")[0] == "digits"
    text = "word " * 50 + "x" * 3000 + "@example.com and (555) 123-4567 " + "y" * 4000
    base, every = pii.find_all([text])[0]
    assert [k for _, k, _ in base] == [0] and base[0][0] == 250
    assert set(base) <= set(every)


def test_long_lines_about_law():
    """What a line says of licences counts by its share of the words, at any length."""
    legal = "This work is licensed under the terms of its licence; all rights reserved. Copyright by the authors. "
    prose = "The old mill stood by the river for more than two hundred years before the flood came. "
    feature = lambda t: 15 in line_rules.line_features(t, t.encode().split(), False)
    assert feature(legal) and feature(legal * 40)
    assert not feature(prose * 40) and not feature(prose * 40 + legal.split(".")[0])


def plain_labels(crf, scores):
    """Viterbi for one sequence, step by step."""
    best, back = [float(s) + float(a) for s, a in zip(crf.start, scores[0])], []
    for row in scores[1:]:
        reach = [[best[i] + float(crf.transition[i, j]) for i in range(len(best))] for j in range(len(best))]
        back.append([r.index(max(r)) for r in reach])
        best = [max(r) + float(s) for r, s in zip(reach, row)]
    out = [best.index(max(best))]
    for b in reversed(back):
        out.append(b[out[-1]])
    return out[::-1]


def documents():
    import pyarrow.parquet as pq

    return {r["doc_id"]: r["text"] for r in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pylist()}


def test_kept_equals_a_plain_decoding(spark):
    """The verdict on every document of the smallest table, by a field decoded line by line."""
    crf, want = line_rules.model(), {}
    for i, text in documents().items():
        lines, seen, content, n = (text or "").split("\n"), set(), 0, 0
        scores, sizes = [], []
        for line in lines:
            words = line.encode().split()
            scores.append(crf.emission[line_rules.line_features(line, words, bool(words) and line in seen)].sum(0))
            seen |= {line} if words else set()
            sizes.append(len(words))
        for label, k in zip(plain_labels(crf, scores), sizes):
            content, n = content + k * (label == 0), n + k
        want[i] = (n, n > 0 and content / n >= line_rules.MIN_CONTENT)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r["doc_id"]: r for r in line_rules.judge(df).collect()}
    assert got.keys() == want.keys()
    assert all((got[i]["n_words"], got[i]["kept"]) == (n, good and not got[i]["base_failed"]) for i, (n, good) in want.items())


def test_spans_equal_a_plain_decoding():
    """The spans of every document of the smallest table, by a field that decodes every word of it."""
    m, texts = pii.model(), list(documents().values())
    for text, (base, every) in zip(texts, pii.find_all(texts)):
        spots = [w.span() for w in re.finditer(r"[^ \t-\r]+", text)]
        if not spots:
            continue
        labels, want, i = plain_labels(m.crf, m.scores([text[s:e] for s, e in spots])), list(base), 0
        while i < len(spots):
            j = i + 1
            if labels[i]:
                while j < len(spots) and labels[j] == labels[i]:
                    j += 1
                s, e = spots[i][0], spots[j - 1][1]
                e -= len(text[s:e]) - len(text[s:e].rstrip(".,;:!?)]}'\""))
                s += len(text[s:e]) - len(text[s:e].lstrip("[{<'\""))
                if all(e <= a or b <= s for a, _, b in base):
                    want.append((s, labels[i] - 1, e))
            i = j
        assert every == sorted(want)
