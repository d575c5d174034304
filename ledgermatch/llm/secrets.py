"""Secret scan: base patterns, and character Markov models for what no pattern names.

Two first-order Markov models over characters, one of random strings and one
of ordinary identifiers, are trained on labelled strings.  A long token, or
what base spans leave free of it, is a secret if the log-likelihood ratio of the
two models is high enough, as a sum and per character.  If it is not as a whole,
its sub-runs of the highest sum are judged the same way (``segments``, linear in
the token), so a random string glued to ordinary text is found.

Labelled strings of the query: in about ``sample_docs`` documents (taken by a
hash over all of them) the values that the base patterns find are random and
all other tokens ordinary; ``SYNTHETIC`` random strings and twice as many
identifiers in the usual spellings, drawn with fixed seeds, stand for what the
sample lacks.  The counts are summed by Spark; what reaches
the driver is one number for each pair of characters and label.

Null texts count as empty.  Repeated rows give the same spans.  Further columns
of the input are ignored.
"""

from __future__ import annotations

import random
import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .spans import by_start, scanned

SAMPLE_DOCS = 4000
SYNTHETIC = 2000
MIN_TOKEN = 20
MIN_SCORE = 15.0
MIN_PER_CHAR = 0.8
KINDS = ["assign", "access", "hex", "random"]
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # runs of 24 and more are the matches of [0-9a-f]+ that stay
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+")

ALPHABET = string.ascii_letters + string.digits + "+/_=-"
_INDEX = {c: i for i, c in enumerate(ALPHABET)}
SIZE = len(ALPHABET)
SEPARATORS = "+/_=-"
REACH = 100


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    return found + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def labelled_tokens(text: str) -> Iterator[tuple[int, str]]:
    """(1, value of a base match) and (0, any other token), weak labels for training."""
    spans = sorted((s, e) for _, s, e in base_spans(text))
    for m in _ASSIGN.finditer(text):
        if len(m[2]) >= 16:
            yield from ((1, t) for t in _TOKEN.findall(m[2]))
    for pattern, least in ((_ACCESS, 20), (_HEX, 24)):
        yield from ((1, t) for t in pattern.findall(text) if len(t) >= least)
    k = 0
    for m in _TOKEN.finditer(text):
        while k < len(spans) and spans[k][1] <= m.start():
            k += 1
        if len(m[0]) >= 6 and (k == len(spans) or spans[k][0] >= m.end()):
            yield 0, m[0]


def synthetic(n: int = SYNTHETIC, seed: int = 7) -> list[str]:
    """Random strings over usual alphabets of keys."""
    rng = random.Random(seed)
    alphabets = ["0123456789abcdef", string.ascii_uppercase + string.digits, string.ascii_letters + string.digits,
                 string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-"]
    return ["".join(rng.choices(alphabets[i % len(alphabets)], k=rng.randint(20, 44))) for i in range(n)]


#: Words that names in programs are made of; training samples of ordinary identifiers join them.
IDENTIFIER_WORDS = """
access account action active address admin after agent alert all amount and api app archive array async auth back balance
base batch before begin block body box branch browser buffer build button by bytes cache call capital category change
channel char check child class clean client clock close cloud code collection color column command comment commit
common compare config connection constant container content context control copy core count country create current
customer data database date day debug default delete deploy device dictionary directory disable display document
domain download driver edit element email empty enable encode end engine entry environment error event example
exception execute expire export extra factory feature fetch field file filter final find first flag folder font for form
format found frame from function gateway generate get global graph group handler hash header health height hello help
history home host hour icon id image import in index info init input insert instance integer interface internal invoice
is item job join json kernel key keyword kind language last layer layout length level library limit line link list load
local location lock log login long loop main manager map margin match max member memory menu message method metric
min minute mode model module month mouse move name network new next node not null number object of offset old on open
option or order origin output owner package page panel parameter parent parse part password path pattern payment
people period phone picture pipeline pixel player plugin point policy pool port position post prefix price print
process product profile project property protocol proxy public publish query queue quick quote random range rate read
record redirect reference region register release remove render report request reset resource response result retry
return role root route row rule run sample save scale schema score screen script search second section security select
send sequence server service session set setting shape share shell show sign simple single size sort source space
speed stack start state static status stop storage store stream string style submit sum switch symbol sync system
table tag target task team template test text theme thread time title to token tool top total track transaction
transfer tree trigger type undo unique unit update upload url user utility valid value variable vector verify version
video view virtual visible volume wait warning watch web weight widget width window with word work world wrapper write
year zero zone""".split()


def identifiers(n: int = 2 * SYNTHETIC, seed: int = 8) -> list[str]:
    """Ordinary identifiers: two to six words in the usual spellings, some with a number behind."""
    rng = random.Random(seed)
    spell = [lambda w: "_".join(w), lambda w: "-".join(w), lambda w: "/".join(w), lambda w: "_".join(w).upper(),
             lambda w: w[0] + "".join(map(str.capitalize, w[1:])), lambda w: "".join(map(str.capitalize, w)),
             lambda w: "".join(w)]
    out = [spell[i % len(spell)](rng.choices(IDENTIFIER_WORDS, k=rng.randint(2, 6))) for i in range(n)]
    return [t + rng.choice(("", "", "", "_", "-")) + str(rng.randint(0, 2030)) if i % 4 == 0 else t for i, t in enumerate(out)]


def pair_counts(tokens: Iterator[tuple[int, str]]) -> Counter:
    counts: Counter = Counter()
    for label, token in tokens:
        counts.update((label, _INDEX[a], _INDEX[b]) for a, b in zip(token, token[1:]))
    return counts


def model(counts: Counter, prior: float = 10.0) -> np.ndarray:
    """log P(next | char, random) - log P(next | char, ordinary).

    Each distribution leans on the label's overall one with the weight of
    ``prior`` pairs, so that a character which ordinary tokens hardly have
    stays unlikely behind any other.
    """
    n = np.zeros((2, SIZE, SIZE))
    for (label, a, b), k in counts.items():
        n[label, a, b] += k
    overall = n.sum(axis=1, keepdims=True) + 1.0
    overall /= overall.sum(axis=2, keepdims=True)
    p = np.log((n + prior * overall) / (n.sum(axis=2, keepdims=True) + prior))
    return p[1] - p[0]


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    total = docs.count()
    keep = max(1, round(1_000_000 * min(1.0, sample_docs / max(total, 1))))
    sample = docs.select(text_of().alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < keep).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = pair_counts(x for b in batches for t in b.column(0) for x in labelled_tokens(t.as_py()))
        rows = [(*k, n) for k, n in counts.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                                         ["label", "a", "b", "n"])

    summed = (sample.mapInArrow(run, "label long, a long, b long, n long")
              .groupBy("label", "a", "b").agg(F.sum("n").alias("n")))  # 2 * 67 * 67 rows at most
    counts = Counter({(r.label, r.a, r.b): r.n for r in summed.collect()})
    counts.update(pair_counts((1, s) for s in synthetic()))
    counts.update(pair_counts((0, s) for s in identifiers()))
    return model(counts)


def score(token: str, ratio: np.ndarray) -> float:
    return float(_pair_scores(token, ratio).sum())


def _pair_scores(token: str, ratio: np.ndarray) -> np.ndarray:
    at = np.fromiter((_INDEX[c] for c in token), dtype=np.int64, count=len(token))
    return ratio[at[:-1], at[1:]]


def segments(scores: list[float]) -> list[tuple[int, int]]:
    """All maximal sub-runs of the highest sum, in order (Ruzzo and Tompa), in linear time."""
    found: list[tuple[int, int, float, float, int]] = []  # start, stop, sum before, sum behind, the last one of a lower sum before
    total = 0.0
    for i, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        start, j = i, len(found) - 1
        while j >= 0 and found[j][2] >= before:
            j = found[j][4]
        while j >= 0 and found[j][3] < total:  # joins all since the j-th
            start, _, before, _, link = found[j]
            del found[j:]
            j = link
        found.append((start, i + 1, before, total, j))
    return [f[:2] for f in found]


def finder(ratio: np.ndarray, min_token: int = MIN_TOKEN, min_score: float = MIN_SCORE,
           min_per_char: float = MIN_PER_CHAR):
    """Spans of one text; what a base span covers is left to it."""
    long_token = re.compile(_TOKEN.pattern[:-1] + "{%d,}" % min_token)

    def secret(scores: np.ndarray) -> bool:
        total, n = scores.sum(), len(scores) + 1
        return n >= min_token and total >= min_score and total >= min_per_char * n

    def random_parts(part: str) -> list[tuple[int, int]]:
        scores = _pair_scores(part, ratio)
        if secret(scores):
            return [(0, len(part))]
        out = []
        for a, b in segments(scores.tolist()):
            # to the separators or ends of the part within REACH, if it stays a secret
            behind = out[-1][1] if out else 0
            a = max(a, behind)
            low, high = max(behind, a - REACH), min(len(part), b + REACH)
            start = max(part.rfind(c, low, a + 1) for c in SEPARATORS) + 1 or (low if low == behind else a)
            stop = min([at for c in SEPARATORS if (at := part.find(c, b, high)) >= 0],
                       default=high if high == len(part) else b + 1)
            if secret(scores[start:stop - 1]):
                out.append((start, stop))
            elif secret(scores[a:b]):
                out.append((a, b + 1))
        return out

    def find(text: str) -> list[tuple[str, int, int]]:
        found = base_spans(text)
        taken, k = sorted((s, e) for _, s, e in found), 0
        for m in long_token.finditer(text):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            at, j = m.start(), k
            while at < m.end():
                free = j == len(taken) or taken[j][0] >= m.end()
                stop = m.end() if free else taken[j][0]
                if stop - at >= min_token:
                    found += [("random", at + s, at + e) for s, e in random_parts(text[at:stop])]
                if free:
                    break
                at, j = max(at, taken[j][1]), j + 1
        return by_start(found, KINDS)

    return find


def secrets(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, min_token: int = MIN_TOKEN,
            min_score: float = MIN_SCORE, min_per_char: float = MIN_PER_CHAR) -> DataFrame:
    """``doc_id, spans`` (kind, start, end in code points) per document."""
    ratio = train(docs, sample_docs)
    return scanned(docs, lambda: finder(ratio, min_token, min_score, min_per_char))
