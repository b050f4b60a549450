"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections.

A text is cut into paragraphs (lines), a paragraph into leaves: the words of its
beginning, then sentences in pieces of 64 characters. Leaves are cut from left to right, so an edit moves none before it. A
paragraph's hash is that of its leaves' hashes; paragraphs form sections, which end after a paragraph whose hash says so, so that an insertion moves no later section; the root's hash is that of its sections. The pieces join to the text,
so equal roots mean equal texts.

The fingerprint is the root in hex, then the tree below it in base64: for each section its hash and number of
paragraphs, for each paragraph its hash and number of leaves, for each leaf 24 bits of hash and its length. Two
fingerprints are compared from the root down, and only branches with different hashes are opened: `likeness` weighs
what they share in the same order by length, `edits` gives the character ranges of differing branches.

Defined results: a null text is an empty one, whose tree has no section; equal texts have likeness 1, also empty
ones. Rows repeat as they do in the input.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from bisect import bisect_left
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshroad.llm.common import field, materialize, pa_type, tidy, with_columns_from

LEAF = re.compile(r"[^.!?\n]{1,64}[.!? ]{0,16}|[.!? ]{1,64}")
# The leaves of a line's beginning are its words, so that short lines are compared by words.
WORD_LEAF = re.compile(r"[^ ]{1,64} {0,16}| {1,64}")
BEGINNING = 200
SECTION_EVERY = 4
ROWS_A_PART = 4_000


def _hash(parts: bytes) -> bytes:
    return hashlib.blake2b(parts, digest_size=16).digest()


def _paragraph(line: str) -> tuple[bytes, bytes, bytes]:
    """Of one line the hash, its entry in a fingerprint and those of its leaves."""
    end = len(line) if len(line) <= BEGINNING else line.rfind(" ", 0, BEGINNING) + 1 or BEGINNING
    pieces = WORD_LEAF.findall(line[:end]) + LEAF.findall(line[end:]) or [""]
    pieces[-1] += "\n"  # the last line gets one too, which all texts share
    hashes = [xxhash.xxh3_128_digest(p.encode()) for p in pieces]
    node = _hash(b"p" + b"".join(hashes))
    return node, node[:6] + len(pieces).to_bytes(4, "big"), b"".join([h[:3] + bytes((min(len(p), 255),)) for h, p in zip(hashes, pieces)])


def fingerprint(text: str | None, known: dict[str, tuple[bytes, bytes, bytes]] | None = None) -> str:
    """The Merkle tree of a text as one string. `known` holds paragraphs by line, and gets those of this text."""
    text = text or ""
    known = {} if known is None else known
    sections, paragraphs, leaves = [], [], []
    open_section: list[bytes] = []
    for line in text.split("\n") if text else []:
        made = known.get(line)
        if made is None:
            made = known[line] = _paragraph(line)
        node, paragraph, below = made
        paragraphs.append(paragraph)
        leaves.append(below)
        open_section.append(node)
        if node[-1] % SECTION_EVERY == 0:
            sections.append((_hash(b"s" + b"".join(open_section)), len(open_section)))
            open_section = []
    if open_section:
        sections.append((_hash(b"s" + b"".join(open_section)), len(open_section)))
    root = _hash(b"r" + b"".join(h for h, _ in sections)).hex()
    body = [b"".join(h[:6] + n.to_bytes(4, "big") for h, n in sections), b"".join(paragraphs), b"".join(leaves)]
    return ".".join([root, *(base64.b64encode(b).decode() for b in body)])


class Tree:
    """A fingerprint read back."""

    def __init__(self, text: str):
        root, *parts = text.split(".")
        sections, paragraphs, leaves = (base64.b64decode(p) for p in parts)
        self.root = root
        self.sections = [(sections[i:i + 6], int.from_bytes(sections[i + 6:i + 10], "big")) for i in range(0, len(sections), 10)]
        self.paragraphs = [(paragraphs[i:i + 6], int.from_bytes(paragraphs[i + 6:i + 10], "big")) for i in range(0, len(paragraphs), 10)]
        self.leaves = np.frombuffer(leaves, dtype=">u4")

    def length(self) -> int:
        return int((self.leaves & 255).sum())


def _in_order(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Places of equal values in both lists, ascending in both: the k-th of a value meets the k-th, then the longest ascending run counts."""
    common = set(a).intersection(b)
    if not common:
        return []
    waiting: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        if b[j] in common:
            waiting.setdefault(b[j], []).append(j)
    met = [(i, q.pop()) for i, v in enumerate(a) if v in common and (q := waiting[v])]
    ends, tails, before = [], [], []
    for n, (_, j) in enumerate(met):
        k = bisect_left(ends, j)
        before.append(tails[k - 1] if k else -1)
        ends[k:k + 1], tails[k:k + 1] = [j], [n]
    out, n = [], tails[-1] if tails else -1
    while n >= 0:
        out.append(met[n])
        n = before[n]
    return out[::-1]


def _gaps(matched: list[tuple[int, int]], a: tuple[int, int], b: tuple[int, int]):
    """What lies between matched places, as ranges of both lists that are not empty."""
    i0, j0 = a[0], b[0]
    for i, j in [*matched, (a[1], b[1])]:
        if i > i0 and j > j0:
            yield (i0, i), (j0, j)
        i0, j0 = i + 1, j + 1


Levels = list[tuple[list[int], list[int]]]


def _levels(body: str) -> Levels:
    """Per level of the tree the hashes of its nodes, and where the nodes below each begin (for leaves: the characters)."""
    sections, paragraphs, leaves = (base64.b64decode(p) for p in body.split("."))
    out = []
    for raw in (sections, paragraphs):
        nodes = struct.Struct(">HII")
        hashes, starts = [], [0]
        for high, low, n in nodes.iter_unpack(raw):
            hashes.append((high << 32) | low)
            starts.append(starts[-1] + n)
        out.append((hashes, starts))
    values = np.frombuffer(leaves, dtype=">u4").astype(np.int64)
    return [*out, (values.tolist(), [0, *np.cumsum(values & 255).tolist()])]


def opened(mark: str) -> tuple[str, Levels]:
    """A fingerprint as its root and its levels, to be compared several times."""
    root, _, body = mark.partition(".")
    return root, _levels(body)


def likeness(a: str | tuple[str, Levels], b: str | tuple[str, Levels]) -> float:
    """Length of what two trees share in the same order, as a share of the length of both.

    Equal roots are equal texts. Below differing roots, sections with equal hashes that stand in the same order are shared
    whole; what lies between them is opened into paragraphs, and what lies between shared paragraphs into leaves.
    """
    (root_a, x), (root_b, y) = (opened(m) if isinstance(m, str) else m for m in (a, b))
    if root_a == root_b:
        return 1.0
    total, shared = x[2][1][-1] + y[2][1][-1], 0
    todo = [((0, len(x[0][0])), (0, len(y[0][0])))]
    for level in range(3):
        (hashes, below), (others, other_below) = x[level], y[level]
        between = []
        for (i0, i1), (j0, j1) in todo:
            matched = [(i0 + i, j0 + j) for i, j in _in_order(hashes[i0:i1], others[j0:j1])]
            for i, _ in matched:
                first, last = below[i], below[i + 1]
                for deeper in x[level + 1:]:  # down to characters
                    first, last = deeper[1][first], deeper[1][last]
                shared += last - first
            between += [((below[p], below[q]), (other_below[r], other_below[t])) for (p, q), (r, t) in _gaps(matched, (i0, i1), (j0, j1))]
        todo = between
    return min(1.0, 2.0 * shared / total) if total else 0.0


def _unmatched(a: list, b: list) -> list[int]:
    """Places in `a` of the nodes that `b` does not hold, as often as it does."""
    there, out = Counter(x[0] for x in b), []
    for i, x in enumerate(a):
        if there[x[0]] > 0:
            there[x[0]] -= 1
        else:
            out.append(i)
    return out


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """Character ranges of the first text's leaves that the second lacks, by opening only branches that differ."""
    if a.partition(".")[0] == b.partition(".")[0]:
        return []
    x, y = Tree(a), Tree(b)
    paragraph_start = np.concatenate([[0], np.cumsum([n for _, n in x.sections])]).astype(int)
    leaf_start = np.concatenate([[0], np.cumsum([n for _, n in x.paragraphs])]).astype(int)
    places = np.concatenate([[0], np.cumsum(x.leaves & 255)]).astype(int)
    y_starts = np.concatenate([[0], np.cumsum([n for _, n in y.sections])]).astype(int)
    y_leaf = np.concatenate([[0], np.cumsum([n for _, n in y.paragraphs])]).astype(int)
    opened = [i for s in _unmatched(x.sections, y.sections) for i in range(paragraph_start[s], paragraph_start[s + 1])]
    other = [i for s in _unmatched(y.sections, x.sections) for i in range(y_starts[s], y_starts[s + 1])]
    differing = [opened[i] for i in _unmatched([x.paragraphs[i] for i in opened], [y.paragraphs[i] for i in other])]
    theirs = [other[i] for i in _unmatched([y.paragraphs[i] for i in other], [x.paragraphs[i] for i in opened])]
    mine = [i for p in differing for i in range(leaf_start[p], leaf_start[p + 1])]
    lacking = _unmatched([(int(x.leaves[i]),) for i in mine], [(int(y.leaves[i]),) for p in theirs for i in range(y_leaf[p], y_leaf[p + 1])])
    ranges: list[tuple[int, int]] = []
    for i in (mine[k] for k in lacking):
        if ranges and ranges[-1][1] == places[i]:
            ranges[-1] = (ranges[-1][0], int(places[i + 1]))
        else:
            ranges.append((int(places[i]), int(places[i + 1])))
    return ranges


def fingerprints(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add `fingerprint` to each row."""
    def make():
        return lambda columns: [[fingerprint(t) for t in columns[0].to_pylist()]]

    return with_columns_from(df, [text], make, [field("fingerprint", T.StringType())], keep)


def edited(text: str, following: str) -> str:
    """The text with its last half, rounded down, replaced by the first as many characters of another."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_neighbour_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows_a_part: int = ROWS_A_PART) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document, by descending id (after the
    last comes the first; equal ids in the order of a hash of the text; null ids last).

    Texts move once: the ids are cut into ranges of about `rows_a_part` rows, each range gets a copy of the first
    document of the next one, and a task walks through its ranges in order.
    """
    d = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    ids = d.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_key"))
    parts = max(1, -(-ids.count() // rows_a_part))
    # First key of each range; the ranges are cut by these from here on.
    first = (ids.repartitionByRange(parts, F.col("_key").desc()).groupBy(F.spark_partition_id().alias("_p"))
             .agg(F.max("_key").alias("_key")))
    starts = np.array(sorted({r["_key"] for r in first.collect()}), dtype=np.int64)
    number = len(starts)

    @F.pandas_udf("int")
    def part_of(key: pd.Series) -> pd.Series:
        # The smallest first key that is not below this one; ranges count from the largest keys.
        return pd.Series(number - 1 - np.searchsorted(starts, key.to_numpy(), side="left")).astype("int32")

    d = d.withColumn("_key", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("_order", F.xxhash64("_text"))
    d = d.withColumn("_part", part_of("_key")).withColumn("_copy", F.lit(False))
    spark = docs.sparkSession
    heads = d.join(F.broadcast(spark.createDataFrame([(int(s),) for s in starts], "_key long")), "_key") if number else d.limit(0)
    heads = heads.groupBy("_part").agg(F.min(F.struct("_order", "_text", "doc_id", "_key")).alias("h")).select(
        "h.doc_id", "h._text", "h._key", "h._order", F.pmod(F.col("_part") - 1, F.lit(max(1, number))).cast("int").alias("_part"), F.lit(True).alias("_copy"))
    heads = materialize(heads, "merkle-heads")
    rows = d.unionByName(heads).repartitionByRange(max(1, number), "_part").sortWithinPartitions(
        "_part", "_copy", F.col("_key").desc(), "_order", "_text")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [T.LongType(), T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()]
    schema = pa.schema([(n, pa_type(k)) for n, k in zip(names, kinds)])

    def run(batches):
        held = None  # the row that waits for the next one
        for batch in batches:
            made = []
            for key, words, part, copy in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "_text", "_part", "_copy"))):
                lines: dict[str, tuple[bytes, bytes, bytes]] = {}
                mark = fingerprint(words, lines)
                tree = opened(mark)
                if held is not None and held[2] == part:
                    new = edited(held[1], words)
                    after = fingerprint(new, held[5] | lines)  # most lines of the edited text are those of the two
                    made.append((held[0], len(held[1]), hashlib.sha256(new.encode()).hexdigest(), held[3], after,
                                 likeness(held[4], opened(after)), likeness(held[4], tree)))
                held = None if copy else (key, words, part, mark, tree, lines)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), schema)], schema=schema)

    return rows.select("doc_id", "_text", "_part", "_copy").mapInArrow(tidy(run), T.StructType([field(n, k) for n, k in zip(names, kinds)]))

