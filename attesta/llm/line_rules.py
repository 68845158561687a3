"""Quality rules: a linear-chain conditional random field labels every line of a text as content or boilerplate.

Viterbi decoding takes a line together with its neighbours; the share of words in content lines decides whether the
text is kept. The field is trained from the small labelled pages below. Base rules on counts come first.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import WHITE, slices
from attesta.llm.crf import CRF

#: Words a text needs, the most words in repeated windows in per cent, and the least share of content words.
MIN_WORDS, MAX_REPEAT, MIN_CONTENT = 50, 50, 0.5
SYMBOLS = "#*$%&|<>"

#: Labelled pages (fixed values): lines beginning with "+ " are content, with "- " boilerplate; a blank line ends a page.
TRAINING = """
- Home | About | News | Contact | Sitemap
+ The old mill stood by the river for more than two hundred years before the flood.
+ Its wheel turned slowly, and the miller knew every sound that it made.
+ In winter, when the ice came down, he would sit up all night.
+ Nobody asked him why.
- Share this page
- All rights reserved.

- Menu | Login | Register | Help | Cart | Search | Store
- Products | Prices | Support | Downloads | Blog
- more | less | next | previous | back | top | end
- red | green | blue | cyan | black | white | pink
- one | two | three | four | five | six. | Seven | eight

+ Die Stadt liegt an einem kleinen Fluss und hat einen alten Markt.
+ Im Sommer kommen viele Menschen, um die Feste zu sehen.
+ Dann ist es laut und schön.
- Licensed under the Apache License, Version 2.0.
- Copyright by the authors.

+ La maison est grande, et le jardin donne sur la mer.
+ Nous y allons chaque année avec les enfants et leurs amis.
+ Là.
+ Quand il pleut, on reste dedans à lire des livres.
- Released under the MIT License.

+ El camino sube por la montaña hasta el pueblo.
+ Desde arriba se ve todo el valle y también el mar.
+ Fin.

- BUY NOW!! BEST!! PRICE!! ONLY!! TODAY!! HURRY!! UP!! FREE!!
- CALL!! NOW!! WIN!! BIG!! CASH!! PRIZES!! EVERY!! DAY!!
- DEAL!! OF!! THE!! WEEK!! IS!! HERE.
- WOW!! THIS!! IS!! IT!!

- Buy### the&&& best*** shoes%%% now$$$ and### save&&& more***
- click*** here### for&&& free%%% stuff.$$$ Best&&& price***
- a%%% b### c&&& d*** e$$$

+ The river was high that year, and the bridge was closed.
- Inwh*** the,*** a$$$ best### of,&&& all.### They$$$ have&&& it%%% here,### now*** and&&& then.$$$ So### come&&& in%%% and*** see.
- Which$$$ one&&& do%%% you### like?*** This&&& or### that,*** mine$$$ or%%% yours.### Ask&&& us*** now.
- Win### now.

- A$$$ new### day&&& in%%% town,*** with### more&&& for$$$ all.%%% Come### here,&&& stay*** there.$$$
+ It was a quiet place with a few shops & an inn, where nothing cost more than $5 in those days.

+ The road was long. It went up, then down, and then up again.
- first | second, | third | fourth. | Fifth | sixth | seventh | eighth. | Ninth
- north | south | east. | West | up | down, | left | right.
- tea | milk | bread | salt, | oil | rice. | Fish | meat

+ Not far from there was a well, and the water was good.
- HERE!! IS,!! WHAT!! YOU!! NEED.!! TAKE!! IT!! OR!! LEAVE!! IT.
- NEVER!! AGAIN,!! THEY!! SAID.!! ALWAYS!! THE!! SAME.

+ A dog ran by. It was brown, with a white spot.
- Runs Runs Runs Runs Runs Runs Runs Runs. Jumps jumps jumps jumps jumps jumps jumps jumps, all all all all all all all.
- Sits, sits, sits, sits, sits, sits, sits, sits.

- spam spam spam spam spam spam spam spam eggs eggs eggs eggs eggs eggs eggs
- cheap cheap cheap cheap cheap cheap cheap cheap cheap
- win win win win win win big big big big big big big
- the the the the the the the on on on on on on on

+ She said that the train would leave at noon, but it was late again.
+ We waited; then we went home, and the day was over.
+ We waited; then we went home, and the day was over.
+ And that was all.
+ The.
+ Of course, there were other days.

- FREE FREE FREE FREE OFFER OFFER OFFER OFFER
- Click here
- Subscribe to our newsletter
- Accept all cookies
- Terms of service | Privacy policy | Imprint
- This site uses cookies. Click accept to go on.

+ Call +1 (212) 555-0147 or write to mail@example.com if you find it.
+ The server at 192.0.2.7 answered after 20 minutes with an error.
+ token = "9742a250774262d69ad6a86100194ed53da5a0ef" was what it sent.
+ Then it was quiet
+ and we could go on with the work that had been planned for the week

- This work is licensed under the GNU General Public License, version 3.
+ A short note on the weather: it rained, it snowed, and then the sun came out.
+ The farmers were glad of it, since the spring had been dry.
- Licensed under CC BY-NC 4.0.
"""

_LEGAL = re.compile(r"licen[sc]e|all rights reserved|copyright|cookie|subscribe|privacy policy|click here|share this|sign up|log ?in\b|terms of", re.I)
#: One of these is in every match.
_LEGAL_PARTS = ("licen", "reserved", "copyright", "cookie", "subscribe", "privacy", "click", "share", "sign", "log", "terms")
_FEATURES = 18


def line_features(line: str, words: list[bytes], seen: bool) -> list[int]:
    """Indices of the features of one line that hold; 0 always does."""
    n = len(words)
    if not n:
        return [0, 1]
    chars = len(line)
    out = [0, 2 if n <= 2 else 3 if n <= 7 else 4]
    symbols = sum(map(line.count, SYMBOLS))
    if symbols:
        if 10 * line.count("|") >= 2 * n:
            out.append(5)
        if 10 * (symbols - line.count("|")) >= 3 * n:
            out.append(6)
        out.append(7)
    shouts = line.count("!")
    if shouts > 1 and 5 * shouts >= n:
        out.append(8)
    upper = sum(map(str.isupper, line)) if line != line.lower() else 0
    if n > 1 and 2 * upper > chars:
        out.append(9)
    distinct = len(set(words))
    if n >= 6 and 2 * distinct < n:
        out.append(10 if 3 * distinct < n else 11)
    if seen:
        out.append(12)
    last = line.rstrip(WHITE)[-1:]
    out.append(13 if last in ".!?…" else 14)
    # a line of ordinary length is about law or the site if it says so once, a longer one if it goes on saying so
    low = line.lower()
    if any(map(low.__contains__, _LEGAL_PARTS)) and 60 * len(_LEGAL.findall(low)) >= n:
        out.append(15)
    if n >= 4 and sum(map(line.count, ",;:.")):
        out.append(16)
    if chars > 30 * n:
        out.append(17)
    return out


def _scores(features: list[list[int]], weights: np.ndarray) -> np.ndarray:
    flat = np.fromiter((i for f in features for i in f), int)
    starts = np.cumsum([0, *map(len, features)])[:-1]
    return np.add.reduceat(weights[flat], starts) if len(features) else np.zeros((0, 2))


@functools.cache
def model() -> CRF:
    """The field trained from the labelled pages: label 0 is content, 1 boilerplate."""
    x, y = [], []
    for page in TRAINING.strip().split("\n\n"):
        rows, gold, seen = [], [], set()
        for line in page.split("\n"):
            gold.append(int(line[0] == "-"))
            words = (text := line[2:]).encode().split()
            row = np.zeros(_FEATURES)
            row[line_features(text, words, text in seen)] = 1
            seen.add(text)
            rows.append(row)
        x.append(np.array(rows))
        y.append(np.array(gold))
    return CRF.fit(x, y, 2, steps=300)


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more, the first occurrence included."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    base = len(index)
    if base < 1 << 21:
        keys = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:
        _, pairs = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)
        _, keys = np.unique(pairs[:-1] * base + ids[2:], return_inverse=True)
    order = np.argsort(keys, kind="stable")
    equal = keys[order[1:]] == keys[order[:-1]]
    if not equal.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    cover = np.zeros(n, bool)
    for k in range(3):
        cover[k : n - 2 + k] |= twice
    return int(cover.sum())


def measure(text: str) -> tuple[int, int, int, int, int, list[list[int]], list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then features and word counts of the lines."""
    words = text.encode().split()
    white = sum(map(text.count, WHITE))
    seen: set[str] = set()
    dup, feats, counts = 0, [], []
    for line in text.split("\n"):
        own = line.encode().split()
        again = bool(own) and line in seen
        dup += again
        if own:
            seen.add(line)
        feats.append(line_features(line, own, again))
        counts.append(len(own))
    return len(words), len(text) - white, sum(map(text.count, SYMBOLS)), dup, repeat_words(words), feats, counts


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_content: float = MIN_CONTENT, with_lines: bool = False) -> DataFrame:
    """Counts, base verdict and verdict of every whole text: one row per input row, with no shuffle.

    Columns: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_share, then
    lines array<boolean> (content or not) if asked for. Null texts have no words and fail the base rules; null ids and
    repeated rows are treated like any other; further columns are not read; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out_schema = f"`{id_col}` {kind}, " + ", ".join(f"{c} bigint" for c in counts) + ", base_failed boolean, kept boolean, content_share double" + ", lines array<boolean>" * with_lines

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = model()
        for b in slices(batches):
            rows = [measure(t or "") for t in b.column(1).to_pylist()]
            sizes = np.array([len(r[6]) for r in rows])
            labels = crf.decode(_scores([f for r in rows for f in r[5]], crf.emission), sizes)
            words = np.array([c for r in rows for c in r[6]])
            content = np.add.reduceat(words * (labels == 0), np.concatenate([[0], np.cumsum(sizes)[:-1]])) if len(rows) else np.zeros(0)
            failed = [n < MIN_WORDS or 100 * rep > MAX_REPEAT * n for n, _, _, _, rep, *_ in rows]
            share = [float(c) / n if (n := r[0]) else 0.0 for c, r in zip(content, rows)]
            cols = [b.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(5)), pa.array(failed, pa.bool_())]
            cols += [pa.array([not f and s >= min_content for f, s in zip(failed, share)], pa.bool_()), pa.array(share, pa.float64())]
            names = [id_col, *counts, "base_failed", "kept", "content_share"]
            if with_lines:
                cut = np.split(labels == 0, np.cumsum(sizes)[:-1])
                cols, names = [*cols, pa.array([x.tolist() for x in cut], pa.list_(pa.bool_()))], [*names, "lines"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, out_schema)
