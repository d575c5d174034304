"""Toxicity by a linear-chain conditional random field that tags toxic words.

Labels mark documents, so token labels come first: a greedy cover picks words
and word beginnings that explain the toxic training documents and that clean
ones lack; words with such a cue in toxic documents are the toxic tokens.  A field with affix,
n-gram and lexicon features is trained on the sequences.  Forward-backward
marginals give the offending offsets, and two of their aggregates (the highest
log-odds and the expected number of toxic words) the document's score, through
a logistic curve fitted on the same documents.

The fit uses a bounded sample: about ``sample_docs`` labelled documents of each
class, of at most ``sample_chars`` characters, by a hash over all labelled
documents; the field's sequences are ``sequence_docs`` of these.  Every document
is scored over its whole text.

A text without letters has no toxic words and the score that goes with none.
Without a labelled document of either class all scores are 0.  Repeated rows
are scored alike; a document with several labels counts as toxic if one says
so.  Further columns are ignored.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, text_of
from .crf import Model, Tagger, matches, train, words_of

SAMPLE_DOCS = 1000
SAMPLE_CHARS = 10_000
SEQUENCE_DOCS = 800
THRESHOLD = 0.7
TOXIC_TOKEN = 0.5
FOLDS, HELD_OUT = 3, 1
CLEAN, TOXIC = 0, 1


def training_sample(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS,
                    sample_chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """(text, toxic) of about ``sample_docs`` different documents per class; follows a hash of the ids."""
    marked = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    sizes = {r.toxic: r.n for r in marked.where(F.col("toxic").isin(0, 1)).groupBy("toxic")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    share = [round(1_000_000 * min(1.0, sample_docs / max(sizes.get(y, 0), 1))) for y in (CLEAN, TOXIC)]
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
                          < F.when(F.col("toxic") == TOXIC, share[TOXIC]).otherwise(share[CLEAN]))
    rows = (docs.select("doc_id", text_of().alias("text")).where(F.length("text").between(1, sample_chars))
            .join(F.broadcast(chosen), "doc_id")  # about 2 * sample_docs rows
            .select("text", "toxic").distinct())
    return sorted((r.text, r.toxic) for r in rows.collect())


def cues_of(word: str) -> list[str]:
    """The word itself and its beginnings of three to six letters."""
    return [f"={word}", *(f"^{word[:n]}" for n in range(3, 7) if len(word) > n)]


def toxic_cues(sample: list[tuple[list[str], int]], least: int = 5, sure: int = 20,
               clean_weight: float = 3.0) -> set[str]:
    """A greedy cover of the toxic documents by cues that clean documents lack.

    Each turn takes the cue with the most uncovered toxic documents, less
    ``clean_weight`` for each clean document that has it (scaled to the same
    number of documents), until none gains ``least``; of equal ones the more
    specific.  Cues of ``sure`` toxic documents and no clean one join them.
    """
    toxic = [{c for w in set(ws) for c in cues_of(w)} for ws, y in sample if y == TOXIC]
    clean = Counter(c for ws, y in sample if y == CLEAN for c in {c for w in set(ws) for c in cues_of(w)})
    scale = clean_weight * len(toxic) / max(1, len(sample) - len(toxic))
    open_docs, chosen = toxic, set()
    while open_docs:
        gain = Counter(c for cs in open_docs for c in cs)
        best = max(gain, key=lambda c: (gain[c] - scale * clean[c], len(c), c), default=None)
        if best is None or gain[best] - scale * clean[best] < least:
            break
        chosen.add(best)
        open_docs = [cs for cs in open_docs if best not in cs]
    if not clean:
        return chosen
    total = Counter(c for cs in toxic for c in cs)
    return chosen | {c for c, n in total.items() if n >= sure and not clean[c]}


def aggregates(p: np.ndarray) -> tuple[float, float]:
    """Log-odds of the most toxic word, log of 1 + the expected number of toxic words among likely ones."""
    if not len(p):
        return -10.0, 0.0
    toxic = p[:, TOXIC].astype(np.float64)
    top = min(max(float(toxic.max()), 1e-5), 1 - 1e-5)
    return float(np.log(top / (1 - top))), float(np.log1p(toxic[toxic >= 0.1].sum()))


def logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.001, steps: int = 25) -> np.ndarray:
    """Weights of a penalised logistic curve with intercept, by Newton steps; both classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)) * len(y)
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + l2 * len(y) * np.eye(x.shape[1])
        b -= np.linalg.solve(h, x.T @ (weight * (p - y)) + l2 * len(y) * b)
    return b


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
        sequence_docs: int = SEQUENCE_DOCS) -> Model:
    """``extra`` holds the weights of the logistic curve; without both classes it is empty."""
    texts = training_sample(docs, labels, sample_docs, sample_chars)
    sample = [(words_of(t), y) for t, y in texts]
    cues = toxic_cues(sample)
    telling = {w for ws, y in sample if y == TOXIC for w in ws if not cues.isdisjoint(cues_of(w))}
    sequences = [(ws, [int(y == TOXIC and w in telling) for w in ws]) for ws, y in sample]
    rng = random.Random(5)
    model = train(rng.sample(sequences, min(len(sequences), sequence_docs)), ["clean", "toxic"],
                  {w: "toxic" for w in telling}, steps=40)
    truth = np.array([y for _, y in texts])
    if len(set(truth.tolist())) == 2:
        x = np.array([aggregates(p) for _, p in Tagger(model).tag([t for t, _ in texts])])
        model.extra["curve"] = logistic(x, truth)
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, spans`` per document; ``spans`` has start, end and probability of each toxic word."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
    curve = model.extra.get("curve")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for b in batches:
            texts, scores, spans = b.column(1).to_pylist(), [], []
            for i, p in tagger.tag(texts):
                x = 0.0 if curve is None else float(np.dot((*aggregates(p), 1.0), curve))
                scores.append(0.0 if curve is None else float(1 / (1 + np.exp(-np.clip(x, -30, 30)))))
                found = []
                if len(p) and p[:, TOXIC].max() >= TOXIC_TOKEN:
                    found = [{"start": m.start(), "end": m.end(), "p": float(q)}
                             for m, q in zip(matches(texts[i]), p[:, TOXIC]) if q >= TOXIC_TOKEN]
                spans.append(found)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(spans, span)],
                                             ["doc_id", "score", "spans"])

    rows = docs.select("doc_id", text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, spans array<struct<start:long,end:long,p:double>>")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_spans`` for all documents; learns from rows that are not held out."""
    fold = fold_of(F.col("doc_id"), FOLDS)
    model = fit(docs, labels.where(fold != HELD_OUT))
    return scored(docs, model).select(
        "doc_id", (fold == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"))
