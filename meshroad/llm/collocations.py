"""Phrase collocations from sorted count streams.

Texts are lower-cased, split at punctuation and line breaks into pieces and at blanks into words. A phrase of 2 to
`LONGEST` words that occurs `LEAST` times or more is a candidate. Its score is 1000 * a * n / (l * r), the least over its
cuts into a first part and a rest (l, r: how often these occur; n: all words of the language). A candidate goes if a
longer one that holds it occurs as often.

Only counts that matter reach the streams: what occurs often enough consists of words, and of pairs of neighbouring words, that do.

1. Words are counted. The frequent ones become a bit map of their hashes.
2. Pairs of frequent neighbours are counted by hash, and the frequent ones become a second bit map. A bit map holds every
   frequent key and perhaps others, so it saves work and loses nothing. Its size is bounded by `MOST_BITS`.
3. Runs of words whose neighbours are all in the second map give phrases of 2 to `LONGEST` words. Tasks count them in
   batches by sorting, and the batches are summed: the count stream, of which the frequent rows are kept.

The stream is kept in two orders: in prefix order (words as they stand) it meets first parts and the phrases that
a word more on the right makes, in suffix order (words from the last to the first) rests and the phrases that a word more
on the left makes. Streams in one order are merge-joined in lockstep, without hash tables, and a key with very many
rows is split by the engine.

Products of counts are decimals of 38 digits, so they are exact up to 10^38; the division gives whole numbers.

Defined results: a null or empty text has no words; a null language is `und`, together with the language of that name;
rows repeat as they do in the input; equal scores are ordered by count, then phrase; an empty table gives no rows. A text of any
length is read as a whole; columns other than text and language are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meshroad.llm.common import BROADCAST_ROWS, in_arrow, materialize

LEAST = 100
LONGEST = 5
TOP = 2_000
UNKNOWN = "und"
# Bits of a map for each key that it holds, and the most that it has (32 MB).
BITS_A_KEY, LEAST_BITS, MOST_BITS = 64, 20, 28
# Bytes of text that a task reads together, keys that it sorts together, and words that it remembers.
GATHER_BYTES = 2_000_000
SORT_KEYS = 2_000_000
REMEMBER = 200_000
SEGMENT = 15  # a bit map is put together in segments of 2^15 bits

BREAK = b"\xff"  # no byte of UTF-8
_TABLE = bytearray(range(256))
_TABLE[65:91] = bytes(range(97, 123))
_TABLE[9] = 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = 255
READ = bytes(_TABLE)


def _tokens(texts: list[bytes]) -> list[bytes]:
    """The words of some texts in order, with a break wherever a piece ends."""
    spaced = BREAK.join(texts).translate(READ).replace(BREAK, b" \xff ")
    return spaced.split()  # of its white space only blanks are left


def _by_language(batches, gather: int = GATHER_BYTES):
    """Language and words of the texts of a task, about `gather` bytes at a time."""
    held: dict[bytes, list[bytes]] = {}
    size: dict[bytes, int] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            some = batch.slice(at, 256)
            for lang, text in zip(some.column(0).cast(pa.binary()).to_pylist(), some.column(1).cast(pa.binary()).to_pylist()):
                if text:
                    held.setdefault(lang, []).append(text)
                    size[lang] = size.get(lang, 0) + len(text)
                    if size[lang] >= gather:
                        yield lang, _tokens(held.pop(lang))
                        size[lang] = 0
            if sum(size.values()) >= 4 * gather:
                for lang in list(held):
                    yield lang, _tokens(held.pop(lang))
                size.clear()
    for lang in list(held):
        yield lang, _tokens(held.pop(lang))


class _Words(dict):
    """Number, hash and frequency mark of each word that a task has met in a language."""

    def __init__(self, lang: bytes, frequent: np.ndarray | None):
        super().__init__()
        self.prefix, self.frequent = lang + BREAK, frequent
        self.hashes, self.marks = [0], [False]
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(self.prefix + word)
        self[word] = number = len(self.hashes)
        self.hashes.append(h)
        self.marks.append(_has_one(self.frequent, h))
        return number

    def numbers(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), dtype=np.int64, count=len(tokens))


def _has_one(bits: np.ndarray, h: int) -> bool:
    at = h & (len(bits) * 8 - 1)
    return bool(bits[at >> 3] >> (at & 7) & 1)


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first ^ (first >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + second
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def _neighbours(words: _Words, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose word and next word are frequent, and the hashes of these pairs."""
    marks = np.array(words.marks)[numbers]
    hashes = np.array(words.hashes, dtype=np.uint64)
    at = np.flatnonzero(marks[:-1] & marks[1:])
    return at, _pair_hashes(hashes[numbers[at]], hashes[numbers[at + 1]])


def word_counts(docs: DataFrame) -> DataFrame:
    """`lang`, `phrase`, `f` for single words."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def run(batches):
        from collections import Counter

        held: dict[bytes, Counter] = {}

        def rows(lang):
            found = held.pop(lang)
            found.pop(BREAK, None)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.binary()).cast(pa.string()),
                                               pa.array(list(found), pa.binary()).cast(pa.string()), pa.array(list(found.values()), pa.int64())], schema=schema)

        for lang, tokens in _by_language(batches):
            held.setdefault(lang, Counter()).update(tokens)
            while sum(map(len, held.values())) > REMEMBER:
                yield rows(max(held, key=lambda x: len(held[x])))
        for lang in list(held):
            yield rows(lang)

    return in_arrow(docs, run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def pair_counts(docs: DataFrame, frequent) -> DataFrame:
    """`h`, `f`: counts of pairs of neighbouring frequent words by hash."""
    schema = pa.schema([("h", pa.int64()), ("f", pa.int64())])

    def run(batches):
        bits, known, held, size = frequent.value, {}, [], 0

        def rows():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], schema=schema)

        for lang, tokens in _by_language(batches):
            words = known.setdefault(lang, _Words(lang, bits))
            _, hashes = _neighbours(words, words.numbers(tokens))
            held.append(hashes)
            size += len(hashes)
            if sum(map(len, known.values())) > REMEMBER:
                known.clear()
            if size >= SORT_KEYS:
                yield rows()
                held, size = [], 0
        if size:
            yield rows()

    return in_arrow(docs, run, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))


def phrase_counts(docs: DataFrame, frequent, linked) -> DataFrame:
    """`lang`, `phrase`, `f` for phrases of 2 to `LONGEST` words, each with all neighbours in the second map."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def phrases(words, tokens):
        numbers = words.numbers(tokens)
        at, hashes = _neighbours(words, numbers)
        at = at[_has(linked.value, hashes)]
        follows = np.zeros(len(tokens) + LONGEST, dtype=bool)  # a place and the next one make a frequent pair
        follows[at] = True
        keys, made, counts = numbers[at], [], []
        for n in range(2, LONGEST + 1):
            _, first, keys, count = np.unique(keys * len(words.hashes) + numbers[at + n - 1], return_index=True, return_inverse=True, return_counts=True)
            made += [b" ".join(tokens[p:p + n]) for p in at[first].tolist()]
            counts.append(count)
            further = follows[at + n - 1]
            at, keys = at[further], keys[further]
            if not len(at):
                break
        return made, np.concatenate(counts) if counts else np.zeros(0, np.int64)

    def run(batches):
        known = {}
        for lang, tokens in _by_language(batches, 2 * GATHER_BYTES):
            words = known.setdefault(lang, _Words(lang, frequent.value))
            made, counts = phrases(words, tokens)
            if sum(map(len, known.values())) > REMEMBER:
                known.clear()
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(made), pa.binary()).cast(pa.string()), pa.array(made, pa.binary()).cast(pa.string()),
                                              pa.array(counts.astype(np.int64))], schema=schema)

    return in_arrow(docs, run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _bit_map(spark: SparkSession, hashes: DataFrame, name: str):
    """The keys (`h`) as a broadcast bit map, of a size that follows their number up to a bound."""
    hashes = materialize(hashes.select("h"), name)
    size = min(MOST_BITS, max(LEAST_BITS, (max(1, hashes.count()) * BITS_A_KEY - 1).bit_length()))
    place = F.col("h").bitwiseAND(F.lit((1 << size) - 1))
    parts = hashes.select(F.shiftright(place, SEGMENT).alias("segment"), place.bitwiseAND(F.lit((1 << SEGMENT) - 1)).cast("int").alias("place"))
    # A segment is a set of 2^15 places at most, so neither a group nor what the driver gets is larger than the map.
    bits = np.zeros(1 << (size - 3), dtype=np.uint8)
    sets = parts.groupBy("segment").agg(F.collect_set("place").alias("places"))
    made = in_arrow(sets, _packed_segments, "segment long, bits binary")
    for row in made.collect():
        start = row["segment"] << (SEGMENT - 3)
        bits[start:start + (1 << (SEGMENT - 3))] = np.frombuffer(row["bits"], dtype=np.uint8)
    return spark.sparkContext.broadcast(bits)


def _packed_segments(batches):
    for batch in batches:
        out = []
        for places in batch.column(1):
            marks = np.zeros(1 << SEGMENT, dtype=bool)
            marks[places.values.to_numpy(zero_copy_only=False)] = True
            out.append(np.packbits(marks, bitorder="little").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["segment", "bits"])


def _hash_words(words: DataFrame) -> DataFrame:
    """Hashes of (lang, phrase), as tasks make them."""

    def run(batches):
        for batch in batches:
            keys = [xxhash.xxh3_64_intdigest(lang + BREAK + word) for lang, word in
                    zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, dtype=np.uint64).view(np.int64))], names=["h"])

    return in_arrow(words.select("lang", "phrase"), run, "h long")


def count_streams(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Counts of all words by language, and the stream of frequent words and phrases (`lang`, `words`, `f`)."""
    spark = docs.sparkSession
    words = materialize(word_counts(docs), "words")
    totals = materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "language-words")
    often = words.filter(F.col("f") >= least)
    frequent = _bit_map(spark, _hash_words(often), "frequent-words")
    linked = _bit_map(spark, pair_counts(docs, frequent).filter(F.col("f") >= least), "frequent-pairs")
    phrases = phrase_counts(docs, frequent, linked).filter(F.col("f") >= least)
    stream = often.unionByName(phrases).select("lang", F.split("phrase", " ").alias("words"), "f")
    return totals, materialize(stream, "frequent-phrases")


def _joined(words: str) -> Column:
    return F.expr(f"array_join({words}, ' ')")


def scored(totals: DataFrame, stream: DataFrame) -> DataFrame:
    """Candidates that stay, each with its lowest-scoring cut: `lang`, `phrase`, `a`, `l`, `r`, `n`, `score`."""
    prefix = materialize(stream.withColumn("key", _joined("words")).repartitionByRange("lang", "key").sortWithinPartitions("lang", "key"), "prefix-order")
    suffix = materialize(stream.withColumn("key", _joined("reverse(words)")).repartitionByRange("lang", "key").sortWithinPartitions("lang", "key"), "suffix-order")

    # A word more on the right: in prefix order, a phrase meets those that begin with it; on the left, in suffix order.
    def longer(ordered: DataFrame, most: str) -> DataFrame:
        made = ordered.filter("size(words) > 2")
        back = made.select("lang", _joined("slice(words, 1, size(words) - 1)" if most == "right" else "reverse(slice(words, 2, size(words) - 1))").alias("key"), "f")
        return back.groupBy("lang", "key").agg(F.max("f").alias(most))

    def lockstep(ordered: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
        return ordered.hint("merge").join(other.hint("merge"), ["lang", "key"], how)

    kept = lockstep(prefix.filter("size(words) > 1"), longer(prefix, "right"), "left").filter("right is null or right < f").select("lang", "words", "f")
    kept = kept.withColumn("key", _joined("reverse(words)"))
    kept = lockstep(kept, longer(suffix, "left"), "left").filter("left is null or left < f").select("lang", "words", "f")
    cuts = kept.select("lang", "words", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.withColumn("key", _joined("slice(words, 1, k)"))
    cuts = lockstep(cuts, prefix.select("lang", "key", F.col("f").alias("l"))).drop("key")
    cuts = cuts.withColumn("key", _joined("reverse(slice(words, k + 1, size(words) - k))"))
    cuts = lockstep(cuts, suffix.select("lang", "key", F.col("f").alias("r"))).drop("key")
    side = F.broadcast(totals) if totals.count() <= BROADCAST_ROWS else totals.hint("merge")
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    product = ((whole("a") * whole("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)")
    cuts = cuts.join(side, "lang").withColumn("_top", product).withColumn("_under", (whole("l") * whole("r")).cast("decimal(38,0)"))
    cuts = cuts.withColumn("score", F.expr("cast(_top div _under as long)"))
    lowest = cuts.groupBy("lang", "words").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c"))
    return lowest.select("lang", _joined("words").alias("phrase"), "c.a", "c.l", "c.r", "c.n", "c.score")


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", *, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first `top` phrases of each language."""
    read = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    totals, stream = count_streams(read, least)
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(totals, stream).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
