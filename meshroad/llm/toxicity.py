"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of the toxic n-grams that it holds, and
a document's score is the noisy-or of its sentences: one offending sentence is enough. The weights are trained from
the labels of documents only; the sentence scores then locate the offending sentences.

The candidates are n-grams of 3 to 6 characters within words (a space marks a word's border), found in one pass of an
Aho-Corasick automaton. Those kept are the `KEPT` that speak most for a toxic document in the sample.

Training uses a bounded sample of labelled rows: about `SAMPLE_ROWS` for each label, whole texts. Rows count by how
common their label is, so scores are on the scale of the whole table.

Defined results: a null or empty text has no sentence and score 0, as has every text when the sample holds only one
label. Rows repeat as they do in the input; a document with several labels counts once for each.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshroad.llm.common import batch_of, field, map_arrow, materialize, with_columns_from
from meshroad.llm.features import bounded_sample

SAMPLE_ROWS = 2_000
KEPT = 1_500
LEAST_DOCUMENTS = 3
SIZES = (3, 4, 5, 6)
# Distinct n-grams of a task are sent on whenever so many have gathered.
FLUSH = 400_000
END = re.compile(r"[.!?\n]+")
NOT_LETTER = re.compile(r"[^\w]|[\d_]")
THRESHOLD = 0.3


def normal(text: str) -> str:
    """Lower case, every character that is no letter a space, the same length; a space before and after."""
    lower = text.lower()
    if len(lower) != len(text):  # a few letters have a longer lower case
        lower = "".join([c if len(c) == 1 else c[0] for c in map(str.lower, text)])
    return " " + NOT_LETTER.sub(" ", lower) + " "


def word_grams(word: str) -> list[str]:
    marked = f" {word} "
    return [marked[i:i + n] for n in SIZES for i in range(len(marked) - n + 1)]


def sentence_ends(text: str) -> list[int]:
    """End offsets of the sentences; the last is the end of the text."""
    ends = [m.end() for m in END.finditer(text)]
    return ends if ends and ends[-1] == len(text) else [*ends, len(text)]


def automaton(grams: list[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, g in enumerate(grams):
        found.add_word(g, (i, len(g)))
    found.make_automaton()
    return found


def bag(text: str | None, machine) -> tuple[int, list[tuple[int, tuple[int, ...]]]]:
    """Number of sentences, and for those with any the features they hold, each once."""
    if not text or not text.strip():
        return 0, []
    hits = [(end, f[0]) for end, f in machine.iter(normal(text))]
    ends = sentence_ends(text)
    filled = sum(1 for a, b in zip([0, *ends], ends) if text[a:b].strip())
    by_sentence: dict[int, set[int]] = {}
    for end, f in hits:
        # `end` is in the text with a space before it; a gram may close with the space after its word.
        by_sentence.setdefault(bisect.bisect_right(ends, max(0, min(end - 2, len(text) - 1))), set()).add(f)
    return filled, [(s, tuple(sorted(fs))) for s, fs in sorted(by_sentence.items())]


class Model:
    def __init__(self, grams: list[str], weights: np.ndarray, bias: float):
        self.grams, self.weights, self.bias = grams, weights, bias

    def sentence_score(self, features) -> float:
        return 1.0 / (1.0 + np.exp(-(self.bias + float(sum(self.weights[f] for f in features)))))

    def document_score(self, count: int, filled) -> float:
        if not self.grams or not count:
            return 0.0
        log_clean = (count - len(filled)) * np.log1p(-self.sentence_score(()))
        for _, fs in filled:
            log_clean += np.log1p(-min(self.sentence_score(fs), 1 - 1e-12))
        return float(-np.expm1(log_clean))


def fit(bags: list[tuple[int, list]], labels: np.ndarray, importance: np.ndarray, features: int, steps: int = 400,
        l2: float = 1e-4, rate: float = 0.3) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the noisy-or likelihood of the labels (Adam over all bags)."""
    owner = np.array([d for d, (_, s) in enumerate(bags) for _ in s], dtype=np.int64)
    sentence = np.array([i for i, fs in enumerate(fs for _, s in bags for _, fs in s) for _ in fs], dtype=np.int64)
    feature = np.array([f for _, s in bags for _, fs in s for f in fs], dtype=np.int64)
    empty = np.array([n - len(s) for n, s in bags], dtype=np.float64)
    importance = importance / importance.sum()
    w, b = np.zeros(features), -6.0
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    for step in range(1, steps + 1):
        z = np.clip(b + np.bincount(sentence, weights=w[feature], minlength=len(owner)), -30, 30)
        p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-b))
        log_clean = np.bincount(owner, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(bags)) + empty * np.log1p(-p0)
        doc = np.clip(-np.expm1(log_clean), 1e-9, 1 - 1e-9)
        # d log-likelihood / d log_clean, and d log_clean / d z = -p.
        slope = importance * np.where(labels == 1, -(1 - doc) / doc, 1.0)
        g_sentence = slope[owner] * -p
        g = np.append(np.bincount(feature, weights=g_sentence[sentence], minlength=features) - l2 * w,
                      g_sentence.sum() + (slope * empty).sum() * -p0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        change = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = np.maximum(w + change[:-1], 0.0), float(np.clip(b + change[-1], -12, 2))
    return w, b


def _gram_counts(sample: DataFrame) -> DataFrame:
    """Documents of either label that hold each n-gram."""
    schema = pa.schema([("gram", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def make():
        def work(batch):
            counts = (Counter(), Counter())

            def flush():
                keys = list(counts[0].keys() | counts[1].keys())
                made = batch_of(schema, [keys, [counts[1][k] for k in keys], [counts[0][k] for k in keys]])
                counts[0].clear()
                counts[1].clear()
                return made

            for text, label in zip(batch.column("_text").to_pylist(), batch.column("_label").to_pylist()):
                words = set(normal(text or "").split())
                counts[label].update({g for w in words for g in word_grams(w)})
                if len(counts[0]) + len(counts[1]) > FLUSH:
                    yield flush()
            yield flush()
        return work

    counted = map_arrow(sample.select("_text", "_label"), make, "gram string, toxic long, clean long")
    return counted.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the documents of `docs` that have a 0 or 1 in `labels`."""
    marks = labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label")).filter("_label in (0, 1)")
    sizes = {r["_label"]: r["count"] for r in marks.groupBy("_label").count().collect()}
    if len(sizes) < 2:
        return Model([], np.zeros(0), 0.0)
    picked = materialize(bounded_sample(marks, F.col("_label"), sample_rows, "_id"), "toxic-labels")
    texts = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    # `picked` has at most four times sample_rows rows.
    sample = materialize(texts.join(F.broadcast(picked), "_id"), "toxic-sample")
    n1, n0 = (sample.filter(F.col("_label") == k).count() for k in (1, 0))
    if not n1 or not n0:
        return Model([], np.zeros(0), 0.0)
    a, b = (F.col("toxic") + 0.5) / (n1 + 1.0), (F.col("clean") + 0.5) / (n0 + 1.0)
    kept = (_gram_counts(sample).filter((F.col("toxic") >= LEAST_DOCUMENTS) & (a > 3 * b))
            .withColumn("_worth", (a - b) * F.log(a / b)).orderBy(F.col("_worth").desc(), "gram").limit(KEPT).collect())
    grams = sorted(r["gram"] for r in kept)
    if not grams:
        return Model([], np.zeros(0), 0.0)

    def make():
        machine = automaton(grams)

        def work(columns):
            found = [bag(t, machine) for t in columns[0].to_pylist()]
            return [[n for n, _ in found], [[x for s, fs in b for x in (-1 - s, *fs)] for _, b in found]]
        return work

    rows = with_columns_from(sample, ["_text"], make, [field("_n", T.LongType()), field("_hits", T.ArrayType(T.IntegerType()))],
                             keep=["_label"]).collect()
    rows.sort(key=lambda r: (r["_label"], r["_n"], r["_hits"]))
    bags = []
    for r in rows:
        sentences: list[tuple[int, list[int]]] = []
        for x in r["_hits"]:
            if x < 0:
                sentences.append((-1 - x, []))
            else:
                sentences[-1][1].append(x)
        bags.append((r["_n"], sentences))
    marked = np.array([r["_label"] for r in rows])
    scale = {1: sizes[1] / n1, 0: sizes[0] / n0}
    w, bias = fit(bags, marked, np.array([scale[k] for k in marked]), len(grams))
    return Model(grams, w, bias)


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Add `score`, `predicted`, and the offending sentences: `offending` (texts) and `offending_score`, worst first."""
    added = [field("score", T.DoubleType()), field("predicted", T.IntegerType()), field("offending", T.ArrayType(T.StringType())),
             field("offending_score", T.ArrayType(T.DoubleType()))]

    def make():
        machine = automaton(model.grams) if model.grams else None

        def work(columns):
            scores, worst, values = [], [], []
            for t in columns[0].to_pylist():
                count, filled = bag(t, machine) if machine else (0, [])
                scores.append(model.document_score(count, filled))
                found = sorted(((model.sentence_score(fs), s) for s, fs in filled), key=lambda x: (-x[0], x[1]))
                found = [x for x in found if x[0] >= threshold]
                ends = [0, *sentence_ends(t)] if found else []
                worst.append([t[ends[s]:ends[s + 1]].strip() for _, s in found])
                values.append([float(p) for p, _ in found])
            return [scores, [int(s >= threshold) for s in scores], worst, values]
        return work

    return with_columns_from(df, [text], make, added, keep)
