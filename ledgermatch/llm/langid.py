"""Language identification of code-switched text by a linear-chain conditional random field.

Words are labelled with languages from affix, character n-gram and lexicon
features and learned transitions; forward-backward gives each word's
distribution.  A document's language is the one with the largest mean over its
words, and that mean is the score.

Training documents carry one language each, so sequences with switches are
spliced from pieces of documents of different languages.  The model is fitted
on a bounded sample: about ``sample_docs`` labelled documents per language of
at most ``sample_chars`` characters, taken by a hash over all labelled
documents, and ``sequences`` spliced sequences.  Every document is predicted
from its whole text.

A null or letterless text has language ``und`` and score 0; without any
labelled document all are ``und``.  Of languages with the same mean the first
in alphabetical order is taken.  Letters are those of ``str.isalpha``.  Repeated rows are predicted alike.  Further
columns of the input are ignored.
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
from .crf import Model, Tagger, lexicon_of, matches, train, words_of

SAMPLE_DOCS = 150
SAMPLE_CHARS = 10_000
SEQUENCES = 3000
FOLDS, HELD_OUT = 4, 2


def training_sample(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS,
                    sample_chars: int = SAMPLE_CHARS) -> list[tuple[str, str]]:
    """(language, text) of about ``sample_docs`` documents per language; the rows follow a hash of the text."""
    rows = labelled.select(F.col("lang").alias("lang"), text_of().alias("text")).where(
        F.col("lang").isNotNull() & F.length("text").between(1, sample_chars))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.greatest(F.lit(1), F.round(F.lit(1_000_000) * F.least(F.lit(1.0), sample_docs / F.col("n"))))
    sample = (rows.join(F.broadcast(sizes), "lang")  # one row per language
              .where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share).select("lang", "text").distinct())
    return sorted((r.lang, r.text) for r in sample.collect())


def splice(sample: list[tuple[str, str]], labels: list[str], sequences: int = SEQUENCES,
           seed: int = 11) -> list[tuple[list[str], list[int]]]:
    """Sequences of one to three pieces of 5 to 30 words, each piece with the language of its document."""
    rng = random.Random(seed)
    by_label = [[ws for lang, text in sample if lang == label and (ws := words_of(text))] for label in labels]
    usable = [y for y, docs in enumerate(by_label) if docs]
    out = []
    for _ in range(sequences if usable else 0):
        words, truth = [], []
        for _ in range(rng.choice((1, 1, 2, 3))):
            y = rng.choice(usable)
            doc = rng.choice(by_label[y])
            at = rng.randrange(len(doc))
            piece = doc[at:at + rng.randint(5, 30)]
            words += piece
            truth += [y] * len(piece)
        out.append((words, truth))
    return out


def fit(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
        sequences: int = SEQUENCES) -> Model:
    sample = training_sample(labelled, sample_docs, sample_chars)
    labels = sorted({lang for lang, _ in sample})
    counts = Counter((w, lang) for lang, text in sample for w in words_of(text))
    return train(splice(sample, labels, sequences), labels, lexicon_of(counts))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, shares`` per document; ``shares`` is each language's part of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(model)
        for b in batches:
            langs, scores, shares = [], [], []
            texts = b.column(1).to_pylist()
            for _, p in tagger.tag(texts) if model.labels else ((i, ()) for i in range(len(texts))):
                if len(p):
                    mean = p.mean(axis=0, dtype=np.float64)
                    best = int(mean.argmax())
                    langs.append(model.labels[best])
                    scores.append(min(1.0, float(mean[best])))
                    shares.append(list(zip(model.labels, map(float, mean))))
                else:
                    langs.append("und")
                    scores.append(0.0)
                    shares.append([])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(shares, pa.map_(pa.string(), pa.float64()))], ["doc_id", "lang_pred", "score", "shares"])

    rows = docs.select("doc_id", text_of().alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, shares map<string,double>")


def segments(text: str, model: Model, tagger: Tagger | None = None) -> list[tuple[int, int, str]]:
    """(start, end, language) of the stretches of one language in a text."""
    (_, p), = (tagger or Tagger(model)).tag([text])
    out: list[tuple[int, int, str]] = []
    for m, y in zip(matches(text), p.argmax(axis=1) if len(p) else []):
        lang = model.labels[y]
        if out and out[-1][2] == lang:
            out[-1] = (out[-1][0], m.end(), lang)
        else:
            out.append((m.start(), m.end(), lang))
    return out


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for all documents; learns from those that are not held out."""
    fold = fold_of(F.col("doc_id"), FOLDS)
    model = fit(docs.where(fold != HELD_OUT))
    return predict(docs, model).select("doc_id", (fold == HELD_OUT).alias("held_out"), "lang_pred", "score")
