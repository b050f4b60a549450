"""Quality classification by co-training.

A document has two views: its text (hashed byte n-grams) and its metadata (source, language, length, lines). One logistic classifier is trained on each view from a few labelled documents. In each round, either one
labels the unlabelled documents that it is most sure of, and these become training rows of the other one. At the end each
view is calibrated on labelled documents that it was not trained on (Platt scaling), and all documents are scored by both:
the log odds are added, the prior counted once.

Training happens on the driver on a bounded sample: about `LABELLED` documents for each label and `UNLABELLED` others, as
feature vectors of fixed size. Scoring covers every document.

Defined results: null and empty texts have an empty text view and are scored by their metadata; null metadata are a value
of their own. With one label only, or none, every score is the share of label 1 among the labels (0.5 for none). Rows
repeat as they do in the input; a document with several labels counts once for each; a label with a null id marks nothing.
A clashing column is replaced. A text of any length is read as a whole, into vectors of fixed size. Documents of equal
margins share their score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshroad.llm.common import field, materialize, with_columns_from
from meshroad.llm.features import bounded_sample, fit_logistic, ngram_counts, unit

LABELLED = 1_000
UNLABELLED = 3_000
ROUNDS = 5
# Pseudo-labels that one view gives the other in a round, for each label in the share that it has among the labels.
SHARED_A_ROUND = 200
SURE = 0.95
BITS = 11
SLOTS = 64
FOLDS = 4
STEPS = 300
HELD_OUT = 100  # with fewer held-out rows than that, calibration is by folds


def text_view(text: str | None) -> np.ndarray:
    return unit(ngram_counts((text or "").encode(), BITS, (1, 2, 3)))


def metadata_view(source: str | None, lang: str | None, text: str | None) -> np.ndarray:
    """What is known of the document without its words: hashed source and language, number of characters and lines."""
    text = text or ""
    lines = text.count("\n") + 1
    shape = np.array([np.log1p(len(text)) / 16, np.log1p(lines) / 12, np.log1p(len(text) / lines) / 16], dtype=np.float32)
    named = np.zeros(SLOTS, np.float32)
    for kind, value in (("source", source), ("lang", lang), ("both", (source, lang))):
        named[xxhash.xxh3_64_intdigest(f"{kind}:{value}") % SLOTS] += 1.0
    bins = np.zeros(len(shape) * 16, np.float32)
    bins[np.arange(len(shape)) * 16 + np.minimum(15, (shape * 16).astype(int))] = 1.0
    return np.concatenate([named, shape, bins]) / 3.0


class Model:
    """Two calibrated views; `prior` alone when there is nothing to tell the labels apart."""

    def __init__(self, prior: float, views: list[tuple[np.ndarray, np.ndarray]] | None = None, scales: list[tuple[float, float]] | None = None,
                 rounds: list[tuple[int, int]] = (), calibrated: list[bool] = ()):
        self.prior, self.views, self.scales, self.rounds, self.calibrated = prior, views, scales, list(rounds), list(calibrated)

    def odds(self, k: int, x: np.ndarray) -> np.ndarray:
        """Calibrated log odds of one view."""
        w, b = self.views[k]
        slope, shift = self.scales[k]
        return slope * (x @ w + b)[:, 0] + shift

    def probabilities(self, texts: np.ndarray, metadata: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both views and their combination."""
        if self.views is None:
            flat = np.full(len(texts), self.prior)
            return flat, flat, flat
        a, b = self.odds(0, texts), self.odds(1, metadata)
        base = np.log(self.prior / (1 - self.prior))
        return sigmoid(a), sigmoid(b), sigmoid(a + b - base)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def platt(z: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[float, float, bool]:
    """Slope and shift of a logistic curve through the margins, and whether the search converged.

    Newton's method with a slight pull to slope 1; a step is halved until the loss falls, so it cannot circle. Margins that
    no curve fits keep slope 1 and shift 0.
    """
    design = np.stack([z, np.ones_like(z)], axis=1)
    weights = weights / weights.mean()
    pull, start = np.array([1.0, 1e-3]), np.array([1.0, 0.0])

    def loss(theta):
        m = design @ theta
        return float(weights @ (np.logaddexp(0.0, m) - y * m) + 0.5 * pull @ (theta - start) ** 2)

    theta, now = start, loss(start)
    for _ in range(100):
        p = sigmoid(design @ theta)
        gradient = design.T @ (weights * (p - y)) + pull * (theta - start)
        step = np.linalg.solve((design * (weights * p * (1 - p))[:, None]).T @ design + np.diag(pull), gradient)
        size = 1.0
        while size > 1e-9 and not loss(theta - size * step) < now:
            size /= 2
        if size <= 1e-9 or not np.isfinite(step).all():
            break
        theta = theta - size * step
        before, now = now, loss(theta)
        if before - now < 1e-10 * max(1.0, before):
            break
    p = sigmoid(design @ theta)
    settled = np.abs(design.T @ (weights * (p - y)) + pull * (theta - start)).max() < 1e-3 * max(1.0, len(z))
    if not settled or theta[0] <= 0:
        return 1.0, 0.0, False
    return float(theta[0]), float(theta[1]), True


def steady_rate(x: np.ndarray, weights: np.ndarray) -> float:
    """The longest step that cannot overshoot: one over the largest curvature of the loss, found by power iteration."""
    share = (weights / weights.sum()).astype(np.float64)
    v, b, size = np.ones(x.shape[1]), 1.0, 1.0
    for _ in range(30):
        m = share * (x @ v + b)
        v, b = x.T @ m, m.sum()
        size = float(np.sqrt(v @ v + b * b))
        v, b = v / size, b / size
    return 3.6 / size  # a little below 4 / size, as the iteration approaches from below


def _folds(y: np.ndarray) -> np.ndarray:
    """Folds take turns within each label, so each has both if there are enough."""
    place = np.empty(len(y), dtype=int)
    for v in (0, 1):
        place[y == v] = np.arange((y == v).sum()) % FOLDS
    return place


def _teach(views: list[np.ndarray], labels: np.ndarray, seeds: np.ndarray, pool: list[int], prior: float, weight_of: dict[int, float], rounds: int):
    """One classifier for each view, before and after each round of handing sure labels of the pool to the other view; and how many
    each gave."""
    given: list[dict[int, int]] = [{}, {}]
    free, history = set(pool), []

    def fit(k, seeds=seeds):
        rows = np.concatenate([seeds, np.array(sorted(given[k]), dtype=int)])
        y = np.concatenate([labels[seeds], np.array([given[k][i] for i in sorted(given[k])], dtype=int)])
        weights = np.array([weight_of[int(v)] for v in y])
        return fit_logistic(views[k][rows], y[:, None].astype(np.float32), weights=weights, steps=STEPS, rate=steady_rate(views[k][rows], weights))

    def confidence(k):
        """The curve from margins to probabilities, on seeds that a model of the other ones has not seen."""
        margins, fold = np.zeros(len(seeds)), _folds(labels[seeds])
        for f in range(FOLDS):
            rest = seeds[fold != f]
            if not (fold == f).any() or len(set(labels[rest])) < 2:
                return 1.0, 0.0
            margins[fold == f] = _margins(fit(k, rest), views[k][seeds[fold == f]])
        return platt(margins, labels[seeds], np.array([weight_of[int(v)] for v in labels[seeds]]))[:2]

    models = [[fit(0), fit(1)]]
    curves = [confidence(0), confidence(1)] if rounds and pool else []
    for _ in range(rounds):
        told, before = [0, 0], sorted(free)
        if not before:
            break
        for k in (0, 1):
            p = sigmoid(curves[k][0] * _margins(models[-1][k], views[k][before]) + curves[k][1])
            ranked = np.argsort(p, kind="stable")
            for label, order, sure in ((1, ranked[::-1], p > SURE), (0, ranked, p < 1 - SURE)):
                most = max(1, int(SHARED_A_ROUND * (prior if label else 1 - prior)))
                for i in [before[j] for j in order[:most] if sure[j]]:
                    if i in free:
                        free.discard(i)
                        given[1 - k][i] = label
                        told[k] += 1
        history.append(tuple(told))
        if not any(told):
            break
        models.append([fit(0), fit(1)])
    return models, history


def _margins(model: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    return (x @ model[0] + model[1])[:, 0].astype(np.float64)


def co_train(views: list[np.ndarray], labels: np.ndarray, prior: float, rounds: int = ROUNDS) -> Model:
    """`labels` holds 0, 1, or -1 for unlabelled rows; `prior` is the share of label 1 in the whole table.

    With `HELD_OUT` labelled rows or more in a quarter of them, that quarter calibrates the views and the rest trains them.
    With fewer, all of them train, and each calibrates as part of a fold that a model of the other folds has not seen. The
    rounds end where the calibrated views together have the least loss on these rows, so that wrong pseudo-labels stay out.
    """
    labelled, pool = np.flatnonzero(labels >= 0), np.flatnonzero(labels < 0).tolist()
    share = (labels[labelled] == 1).mean()
    weight_of = {1: prior / share, 0: (1 - prior) / (1 - share)}
    place = _folds(labels[labelled])
    teach = lambda seeds: _teach(views, labels, seeds, pool, prior, weight_of, rounds)
    if (place == 0).sum() >= HELD_OUT:
        held = np.flatnonzero(place == 0)
        models, history = teach(labelled[place != 0])
        tried = [(models, held)]
    else:
        held = np.arange(len(labelled))
        models, history = teach(labelled)
        tried = []
        for fold in range(FOLDS):
            rest, mine = labelled[place != fold], np.flatnonzero(place == fold)
            if len(mine):
                tried.append((teach(rest)[0] if len(set(labels[rest])) == 2 else models, mine))
    y = labels[labelled[held]]
    weights = np.array([weight_of[int(v)] for v in y])
    best = None
    for n in range(len(models)):
        margins = np.zeros((2, len(labelled)))
        for found, rows in tried:
            for k in (0, 1):
                margins[k][rows] = _margins(found[min(n, len(found) - 1)][k], views[k][labelled[rows]])
        fits = [platt(margins[k][held], y, weights) for k in (0, 1)]
        odds = sum(fits[k][0] * margins[k][held] + fits[k][1] for k in (0, 1)) - np.log(prior / (1 - prior))
        loss = float(weights @ (np.logaddexp(0.0, odds) - y * odds))
        if best is None or loss < best[0] - 1e-9:
            best = (loss, n, fits)
    _, n, fits = best
    return Model(prior, models[n], [f[:2] for f in fits], history[:n], [f[2] for f in fits])


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
          label: str = "quality") -> Model:
    marks = labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label")).filter("_label in (0, 1)")
    sizes = {r["_label"]: r["count"] for r in marks.groupBy("_label").count().collect()}
    if len(sizes) < 2:
        return Model(1.0 if 1 in sizes else 0.0 if sizes else 0.5)
    prior = sizes[1] / (sizes[0] + sizes[1])
    picked = materialize(bounded_sample(marks, F.col("_label"), LABELLED, "_id"), "quality-labels")
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in ((doc_id, "_id"), (text, "_text"), (source, "_source"), (lang, "_lang"))])
    known = rows.join(F.broadcast(picked), "_id")  # bounded by the sample
    others = bounded_sample(rows, F.lit(1), UNLABELLED, "_id").join(F.broadcast(picked.select("_id")), "_id", "left_anti").withColumn("_label", F.lit(-1))

    def make():
        def work(columns):
            source_, lang_, text_ = (c.to_pylist() for c in columns)
            return [pa.array([text_view(t).astype(np.float16).tobytes() for t in text_], pa.binary()),
                    pa.array([metadata_view(*v).astype(np.float16).tobytes() for v in zip(source_, lang_, text_)], pa.binary())]
        return work

    got = with_columns_from(known.unionByName(others), ["_source", "_lang", "_text"], make,
                            [field("_a", T.BinaryType()), field("_b", T.BinaryType())], keep=["_label"]).collect()
    got = sorted((xxhash.xxh3_64_intdigest(bytes(r["_a"]) + bytes(r["_b"])), r["_label"], bytes(r["_a"]), bytes(r["_b"])) for r in got)
    marked = np.array([g[1] for g in got])
    if len({*marked[marked >= 0].tolist()}) < 2:
        return Model(prior)
    views = [np.frombuffer(b"".join(g[k] for g in got), dtype=np.float16).reshape(len(got), -1).astype(np.float32) for k in (2, 3)]
    return co_train(views, marked, prior)


def score(docs: DataFrame, model: Model, text: str = "text", source: str = "source", lang: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """Add `text_score`, `metadata_score`, `score` (their combination) and `predicted`."""
    added = [*(field(n, T.DoubleType()) for n in ("text_score", "metadata_score", "score")), field("predicted", T.IntegerType())]

    def make():
        def work(columns):
            source_, lang_, text_ = (c.to_pylist() for c in columns)
            out = [[], [], []]
            for s in range(0, len(text_), 256):
                part = slice(s, s + 256)
                a = np.stack([text_view(t) for t in text_[part]])
                b = np.stack([metadata_view(*v) for v in zip(source_[part], lang_[part], text_[part])])
                for o, p in zip(out, model.probabilities(a, b)):
                    o += p.astype(float).tolist()
            return [*out, [int(p >= 0.5) for p in out[2]]]
        return work

    return with_columns_from(docs, [source, lang, text], make, added, keep)
