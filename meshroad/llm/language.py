"""Language identification by error-correcting output codes.

Each language has a codeword of +1 and -1. For each bit, one binary classifier over hashed byte n-grams of the
letters predicts it. A text's language is the one whose codeword has the least loss against the predicted margins,
each bit weighted by how well its classifier does on that language; a small gap to the second is flagged.

The classifiers are trained on the driver from a bounded sample of labelled rows, `SAMPLE_ROWS` in all, which holds as
many rows of a rare language as of a common one; only fixed-size feature vectors reach the driver.

Defined results: a null text and one without a letter is `und` with score 0, as is everything when there is nothing
to learn from; with one language learned, every other text gets it with score 1. Rows repeat as they do in the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshroad.llm.common import field, with_columns_from
from meshroad.llm.features import bounded_sample, fit_logistic, ngram_counts, unit

SAMPLE_ROWS = 3_200
BITS = 12
ORDERS = (1, 2, 3)
UNKNOWN = "und"
AMBIGUOUS_GAP = 0.1


def letters(text: str) -> bytes:
    """Lower-case letters, with one space for whatever stands between two words."""
    text = text.lower()
    if text.isascii():
        return b" " + b" ".join(text.encode().translate(_ONLY_LETTERS).split()) + b" "
    return (" " + " ".join("".join([c if c.isalpha() else " " for c in text]).split()) + " ").encode()


_ONLY_LETTERS = bytes(b if 97 <= b <= 122 else 32 for b in range(256))


def features(text: str | None) -> np.ndarray | None:
    """Feature vector of a text; None if it has no letter."""
    raw = letters(text) if text else b""
    return unit(ngram_counts(raw, BITS, ORDERS)) if raw.strip() else None


def codewords(languages: int) -> np.ndarray:
    """One row of +1 and -1 for each language: every split of the languages for up to six, random ones beyond."""
    if languages < 2:
        return np.ones((languages, 1))
    if languages <= 6:
        splits = range(1, 2 ** (languages - 1))
        return np.array([[1.0 if k == 0 or not s >> (k - 1) & 1 else -1.0 for s in splits] for k in range(languages)])
    rng, bits = np.random.default_rng(11), int(np.ceil(10 * np.log2(languages)))
    tries = [np.where(rng.random((languages, bits)) < 0.5, 1.0, -1.0) for _ in range(50)]
    tries = [t[:, np.abs(t.sum(axis=0)) < languages] for t in tries]
    return max(tries, key=lambda t: min(int((t[i] != t[j]).sum()) for i in range(languages) for j in range(i)))


class Model:
    def __init__(self, languages: list[str], x: np.ndarray, y: np.ndarray):
        self.languages, self.codes = languages, codewords(len(languages))
        if len(languages) < 2:
            return
        bits = (self.codes[y] > 0).astype(np.float32)
        counts = np.bincount(y, minlength=len(languages))
        self.w, self.b = fit_logistic(x, bits, weights=1.0 / counts[y])
        right = ((x @ self.w + self.b > 0) == (bits > 0)).astype(float)
        good = np.array([right[y == k].mean(axis=0) for k in range(len(languages))])
        good = np.maximum(good, 1e-3)
        self.weights = good / good.sum(axis=1, keepdims=True)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score and gap to the second best, for each row."""
        if len(self.languages) < 2:
            return np.zeros(len(x), int), np.ones(len(x)), np.ones(len(x))
        margins = x @ self.w + self.b
        losses = np.logaddexp(0.0, -margins[:, None, :] * self.codes[None]) * self.weights[None]
        total = losses.sum(axis=2) * self.codes.shape[1]
        odds = np.exp(total.min(axis=1, keepdims=True) - total)
        odds /= odds.sum(axis=1, keepdims=True)
        ranked = np.sort(odds, axis=1)
        return total.argmin(axis=1), odds.max(axis=1), ranked[:, -1] - ranked[:, -2]


def train(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the rows with a language."""
    rows = labelled.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"), F.col(f"`{lang}`").alias("_lang")).filter("_lang is not null")
    kinds = rows.select("_lang").distinct().count()
    picked = bounded_sample(rows, F.col("_lang"), max(20, sample_rows // max(1, kinds)), "_id")

    def make():
        def work(columns):
            found = [features(t) for t in columns[0].to_pylist()]
            return [pa.array([None if f is None else f.astype(np.float16).tobytes() for f in found], pa.binary())]
        return work

    got = with_columns_from(picked, ["_text"], make, [field("_x", T.BinaryType())], keep=["_lang"]).filter("_x is not null").collect()
    got = sorted(((r["_lang"], bytes(r["_x"])) for r in got))
    languages = sorted({g[0] for g in got})
    if not got:
        return Model([], np.zeros((0, 1 << BITS)), np.zeros(0, int))
    x = np.frombuffer(b"".join(g[1] for g in got), dtype=np.float16).reshape(len(got), -1).astype(np.float32)
    place = {k: i for i, k in enumerate(languages)}
    return Model(languages, x, np.array([place[g[0]] for g in got]))


def identify(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add `lang_pred`, `score` (0 to 1) and `ambiguous`."""
    added = [field("lang_pred", T.StringType()), field("score", T.DoubleType()), field("ambiguous", T.BooleanType())]

    def make():
        def work(columns):
            texts = columns[0].to_pylist()
            preds, scores, doubts = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            for start in range(0, len(texts) if model.languages else 0, 256):
                found = [(i, f) for i in range(start, min(start + 256, len(texts))) if (f := features(texts[i])) is not None]
                if found:
                    best, score, gap = model.predict(np.stack([f for _, f in found]))
                    for (i, _), k, s, g in zip(found, best, score, gap):
                        preds[i], scores[i], doubts[i] = model.languages[k], float(s), bool(g < AMBIGUOUS_GAP)
            return [preds, scores, doubts]
        return work

    return with_columns_from(df, [text], make, added, keep)


