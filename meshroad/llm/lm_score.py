"""Language-model scoring by cross-entropy difference.

Two bigram models are counted from the corpus: one of the target documents, one of the background, which is all
documents. They share one vocabulary, the order and the smoothing, and the background's counts are scaled to the mass of
the target's, so a difference in loss comes from the texts alone. A document's score is the mean over its tokens of
background loss minus target loss (nats): the higher, the closer it is to the target.

Tokens are lower-case words and runs of punctuation; a start mark stands before the first. The vocabulary holds the
`VOCABULARY` most frequent tokens of all documents; the others are one token, `unknown`. The probability of a token is
P(w) = (c(w) + ALPHA) / (N + ALPHA * V) and P(w | h) = (c(h, w) + PRIOR * P(w)) / (c(h) + PRIOR), c(h) being all occurrences of h. A document's own counts
are taken out of both models before it is scored, else target documents would be known by heart.

Every bigram of every document is counted; none is dropped or pruned, so the tables grow with the corpus. Documents are
cut into blocks of about `BLOCK_TOKENS` tokens. A block sends each of its distinct bigrams once, with its counts, in packed parts of the bigram
space; where all counts of a part meet, they are added up and sent back to the blocks, in the order in which they came.

Defined results: a null text or one without tokens has no score (null). Rows repeat as they do in the input and count
each time. Without target documents the target model is the smoothed background vocabulary, and scores are still defined.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshroad.llm.common import BROADCAST_ROWS, batch_of, map_arrow, materialize, tidy

VOCABULARY = 50_000
PRIOR = 5.0
ALPHA = 0.5
BLOCK_TOKENS = 6_000_000
# Bigrams that a task adds up at a time, about.
PART_BIGRAMS = 2_000_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
# Counts the documents with tokens; no token is empty.
DOCUMENT = ""
START = 0
UNKNOWN = 1
FLUSH = 500_000


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def _token_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of each token in all documents and in the target ones."""
    schema = pa.schema([("token", pa.string()), ("all", pa.int64()), ("target", pa.int64())])

    def make():
        def work(batch):
            counts, target = Counter(), Counter()

            def flush():
                keys = list(counts)
                made = batch_of(schema, [keys, [counts[k] for k in keys], [target[k] for k in keys]])
                counts.clear()
                target.clear()
                return made

            for text, mark in zip(batch.column("_text").to_pylist(), batch.column("_target").to_pylist()):
                found = tokens(text)
                if found:
                    found.append(DOCUMENT)
                counts.update(found)
                if mark:
                    target.update(found)
                if len(counts) > FLUSH:
                    yield flush()
            yield flush()
        return work

    made = map_arrow(docs.select("_text", "_target"), make, "token string, all long, target long")
    return made.groupBy("token").agg(F.sum("all").alias("all"), F.sum("target").alias("target"))


class Unigrams:
    """Vocabulary with counts; index 0 is the start mark, 1 the unknown token."""

    def __init__(self, words: list[str], every: np.ndarray, target: np.ndarray, documents: tuple[int, int]):
        self.ids = {w: i + 2 for i, w in enumerate(words)}
        self.kind = "<u2" if len(words) + 2 <= 1 << 16 else "<u4"
        self.history = np.array([np.concatenate([[documents[k]], c]) for k, c in enumerate((every, target))], dtype=np.float64)
        self.scale = self.history[1, 1:].sum() / max(1.0, self.history[0, 1:].sum())
        self.history[0] *= self.scale
        self.mass = self.history[:, 1:].sum(axis=1)

    def loss(self, k: int, pairs: np.ndarray, counts: np.ndarray, own: tuple[np.ndarray, np.ndarray, np.ndarray] | None) -> float:
        """Mean loss of a document's bigrams under the background (k = 0) or target model (k = 1), given their counts in
        it and the document's own counts of bigram, history and token at each place, if it is part of that model."""
        unit = self.scale if k == 0 else 1.0
        h, w = pairs >> 32, pairs & 0xFFFFFFFF
        both, before, alone, mass = counts * unit, self.history[k, h], self.history[k, w], self.mass[k]
        if own is not None:
            both, before, alone, mass = both - own[0] * unit, before - own[1] * unit, alone - own[2] * unit, mass - len(pairs) * unit
        share = (np.maximum(alone, 0.0) + ALPHA) / (max(mass, 0.0) + ALPHA * (self.history.shape[1] - 1))
        return float(-np.log((np.maximum(both, 0.0) + PRIOR * share) / (np.maximum(before, 0.0) + PRIOR)).mean())


def _own(values: np.ndarray) -> np.ndarray:
    """How often the value at each place occurs."""
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    return counts[inverse]


def _blocks(docs: DataFrame, shared) -> DataFrame:
    """Documents as token numbers (packed 32-bit), each with the number of its block, which a rerun of the task repeats."""
    schema = pa.schema([("block", pa.int64()), ("row", pa.int64()), ("_id", pa.int64()), ("_target", pa.bool_()), ("ids", pa.binary())])

    def run(batches):
        ids, kind, block, size, row = shared.value.ids, shared.value.kind, TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            made = []
            for number, text, mark in zip(*(batch.column(c).to_pylist() for c in ("_id", "_text", "_target"))):
                found = tokens(text)
                packed = np.fromiter((ids.get(t, UNKNOWN) for t in found), dtype=kind, count=len(found)).tobytes()
                if size > BLOCK_TOKENS:
                    block, size = block + 1, 0
                size += len(found)
                made.append((block, row, number, bool(mark), packed))
                row += 1
            if made:
                yield batch_of(schema, list(zip(*made)))

    return docs.select("_id", "_text", "_target").mapInArrow(tidy(run), "block long, row long, _id long, _target boolean, ids binary")


def _pairs(ids: bytes, kind: str) -> np.ndarray:
    """History and token of each place as one number."""
    w = np.frombuffer(ids, dtype=kind).astype(np.int64)
    h = np.concatenate([[START], w[:-1]]) if len(w) else w
    return (h << 32) | w


def _in_parts(pairs: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of distinct ascending pairs by part, then pair, and the first place of each part (and the end)."""
    part = ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _pack(values: np.ndarray) -> bytes:
    """Unsigned integers in the fewest bytes of 1, 2, 4 or 8 that hold them, which the first byte names."""
    size = next(k for k in (1, 2, 4, 8) if not len(values) or int(values.max()) < 1 << (8 * k))
    return bytes([size]) + values.astype(f"<u{size}").tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{raw[0]}", offset=1).astype(np.int64)


def _distinct(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(pieces), return_counts=True) if pieces else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _bigrams(blocks: DataFrame, kind: str, parts: int) -> DataFrame:
    """Each block's distinct bigrams with their counts, a row for each part."""
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("pairs", pa.binary()), ("every", pa.binary()), ("target", pa.binary())])

    def run(batches):
        held, block = [], None

        def finish():
            pairs, counts = _distinct([p for p, _ in held])
            marked, some = _distinct([p for p, m in held if m])
            target = np.zeros(len(pairs), np.int64)
            target[np.searchsorted(pairs, marked)] = some
            order, starts = _in_parts(pairs, parts)
            pairs, counts, target = pairs[order], counts[order], target[order]
            # Histories and tokens apart: the histories, in order, compress well.
            made = [(k, block, _pack(pairs[a:b] >> 32) + _pack(pairs[a:b] & 0xFFFFFFFF), _pack(counts[a:b]), _pack(target[a:b]))
                    for k, (a, b) in enumerate(zip(starts, starts[1:])) if b > a]
            return batch_of(schema, list(zip(*made)) if made else [[]] * 5)

        for batch in batches:
            for number, mark, ids in zip(*(batch.column(c).to_pylist() for c in ("block", "_target", "ids"))):
                if held and number != block:  # a task's rows come block by block
                    yield finish()
                    held.clear()
                block = number
                held.append((_pairs(ids, kind), mark))
        if held:
            yield finish()

    return blocks.select("block", "_target", "ids").mapInArrow(tidy(run), "part long, block long, pairs binary, every binary, target binary")


def _halves(raw: bytes, count: int) -> np.ndarray:
    cut = 1 + raw[0] * count
    return (_unpack(raw[:cut]) << 32) | _unpack(raw[cut:])


def _added(bigrams: DataFrame) -> DataFrame:
    """The counts of each row of `_bigrams` replaced by those of all blocks."""
    schema = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("every", pa.binary()), ("target", pa.binary())])

    def run(batches):
        part, held = None, []

        def finish():
            sums = [_unpack(h[2]) for h in held]
            lengths = [len(x) for x in sums]
            _, inverse = np.unique(np.concatenate([_halves(h[1], n) for h, n in zip(held, lengths)]), return_inverse=True)
            every = np.bincount(inverse, weights=np.concatenate(sums)).astype(np.int64)[inverse]
            target = np.bincount(inverse, weights=np.concatenate([_unpack(h[3]) for h in held])).astype(np.int64)[inverse]
            cuts = np.cumsum(lengths)[:-1]
            rows = [(h[0], part, _pack(e), _pack(t)) for h, e, t in zip(held, np.split(every, cuts), np.split(target, cuts))]
            return batch_of(schema, list(zip(*rows)))

        for batch in batches:
            for number, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "block", "pairs", "every", "target"))):
                if held and number != part:
                    yield finish()
                    held.clear()
                part = number
                held.append(row)
        if held:
            yield finish()

    ordered = bigrams.repartition("part").sortWithinPartitions("part", "block")
    return ordered.mapInArrow(tidy(run), "block long, part long, every binary, target binary")


def score(docs: DataFrame, target_ids: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY) -> DataFrame:
    """Per document: `n_tokens`, `target_loss` and `background_loss` (means per token) and `score`, their difference.

    `target_ids` names the target documents in a column like `doc_id`.
    """
    marks = target_ids.select(F.col(f"`{doc_id}`").cast("long").alias("_id")).filter("_id is not null").distinct().withColumn("_target", F.lit(True))
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id"), F.col(f"`{text}`").alias("_text"))
    d = d.join(F.broadcast(marks) if marks.count() <= BROADCAST_ROWS else marks, "_id", "left")
    counts = materialize(_token_counts(d), "lm-tokens")
    sizes = counts.filter(F.col("token") == DOCUMENT).agg(F.sum("all").alias("n"), F.sum("target").alias("t")).first()
    words = counts.filter(F.col("token") != DOCUMENT)
    sums = words.agg(F.sum("all").alias("a"), F.sum("target").alias("t")).first()
    top = words.orderBy(F.col("all").desc(), "token").limit(vocabulary).collect()
    every, target = (np.array([(total or 0) - sum(r[c] for r in top), *(r[c] for r in top)], dtype=np.float64)
                     for c, total in (("all", sums.a), ("target", sums.t)))
    unigrams = Unigrams([r["token"] for r in top], every, target, (sizes.n or 0, sizes.t or 0))
    shared = docs.sparkSession.sparkContext.broadcast(unigrams)  # bounded by the vocabulary

    blocks = materialize(_blocks(d, shared), "lm-blocks")
    kind, parts = unigrams.kind, max(1, int((sums.a or 0) // PART_BIGRAMS))
    added = _added(_bigrams(blocks, kind, parts))
    # A block's documents in order, then the counts of its bigrams: one block is held at a time.
    left = blocks.select("block", F.lit(0).alias("kind"), F.col("row").alias("place"), "_id", "_target", "ids",
                         F.lit(None).cast("binary").alias("every"), F.lit(None).cast("binary").alias("target"))
    right = added.select("block", F.lit(1).alias("kind"), F.col("part").alias("place"), F.lit(None).cast("long").alias("_id"),
                         F.lit(None).cast("boolean").alias("_target"), F.lit(None).cast("binary").alias("ids"), "every", "target")
    together = left.union(right).repartition("block").sortWithinPartitions("block", "kind", "place")
    out = pa.schema([("_id", pa.int64()), ("n_tokens", pa.int64()), ("target_loss", pa.float64()), ("background_loss", pa.float64())])

    def apply(batches):
        models, block, texts, counts = shared.value, None, [], []

        def finish():
            pieces = [_pairs(ids, kind) for _, _, ids in texts]
            pairs, _ = _distinct(pieces)
            order, _ = _in_parts(pairs, parts)
            every, target = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            if counts:
                every[order], target[order] = (np.concatenate([_unpack(c[k]) for c in counts]) for k in (0, 1))
            made = []
            for (number, mark, _), mine in zip(texts, pieces):
                if not len(mine):
                    made.append((number, 0, None, None))
                    continue
                at = np.searchsorted(pairs, mine)
                alone = _own(mine & 0xFFFFFFFF)
                own = _own(mine), np.concatenate([[1], alone[:-1]]), alone  # the first history is the start mark, once
                made.append((number, len(mine), models.loss(1, mine, target[at], own if mark else None), models.loss(0, mine, every[at], own)))
            return batch_of(out, list(zip(*made)))

        for batch in batches:
            for number, which, *row in zip(*(batch.column(c).to_pylist() for c in ("block", "kind", "_id", "_target", "ids", "every", "target"))):
                if number != block and block is not None:
                    yield finish()
                    texts.clear()
                    counts.clear()
                block = number
                if which:
                    counts.append(row[3:])
                else:
                    texts.append(row[:3])
        if texts:
            yield finish()

    scored = together.mapInArrow(tidy(apply), T.StructType([T.StructField("_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
                                                      T.StructField("target_loss", T.DoubleType()), T.StructField("background_loss", T.DoubleType())]))
    return scored.select(F.col("_id").alias(doc_id), "n_tokens", "target_loss", "background_loss",
                         (F.col("background_loss") - F.col("target_loss")).alias("score"))
