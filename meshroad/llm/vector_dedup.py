"""Near-duplicate vectors by cross-polytope hashing.

A vector is turned by three rounds of random signs and fast Hadamard transforms; its hash is the coordinate of greatest
magnitude, with its sign. A bucket of a table is given by several such hashes, the last one over the first few
coordinates only, so that a table has at least `ROOM` times as many buckets as the largest label has classes (in few
dimensions, as many as neighbourhoods of cosine 0.93 fill the sphere). Rows that meet a random vector of 32 dimensions in a
table: 5.4, 7.5 and 11.3 of 5,000, 20,000 and 80,000, measured. `FUNCTIONS` hashes are the fewest, with `TABLES` tables; each
further one takes `MORE_TABLES` times the tables, as a pair of cosine 0.93 then meets in about 0.62 of the tables it met in
before. Each vector stands in its own bucket and is also looked up in the buckets that it missed by least (multiprobe),
`PROBES` in all. Vectors that meet in a bucket, at least one of them standing there, are compared in double precision.

Equal vectors of one label form a class and are hashed once. Buckets of more than `BLOCK` rows are cut into blocks, and
pairs of blocks are compared in tasks of bounded size. Pairs are never written out: a task gives the number of links of
each class and a spanning forest of them. A pair that meets in several buckets counts in the first of them only.

Links hold between equal labels and equal dimensions only. Labels and vectors that are null, and vectors that are zero,
empty, or hold null or non-finite components, link with nothing. Rows with one id are one vector, the first by label and
vector. A null id links with nothing and has a null component.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshroad.llm.common import batch_of, map_arrow, materialize, tidy
from meshroad.llm.components import components

THRESHOLD = 0.93
TABLES = 6
FUNCTIONS = 2
MORE_TABLES = 5 / 3
ROOM = 2
PROBES = 3
BLOCK = 1_024
SEED = 5


class CrossPolytope:
    """Hashes for one dimension and up to `classes` vectors of a label; the same in every task."""

    def __init__(self, dimension: int, classes: int = 0, probes: int = PROBES):
        self.size = 1 << max(1, (dimension - 1).bit_length())
        # Coordinates that each function looks at: all of them, but for the last one, which has just enough.
        self.widths = [self.size] * FUNCTIONS
        # In few dimensions, buckets smaller than the neighbourhood of a vector would cut it up and save nothing.
        room = int(min(ROOM * classes, math.exp(min(60.0, -(dimension - 1) * math.log(math.sqrt(1 - THRESHOLD ** 2))))))
        while (2 * self.size) ** len(self.widths) < room:
            self.widths.append(self.size)
        if len(self.widths) > FUNCTIONS:
            rest = -(-room // (2 * self.size) ** (len(self.widths) - 1))
            self.widths[-1] = 1 << (-(-rest // 2) - 1).bit_length()
        self.tables, self.functions, self.probes = math.ceil(TABLES * MORE_TABLES ** (len(self.widths) - FUNCTIONS)), len(self.widths), probes
        rng = np.random.default_rng((SEED, dimension))
        self.signs = rng.choice([-1.0, 1.0], (self.tables, self.functions, 3, self.size))
        # Of the choices of a rank for each function, those that have too many at least as good ones are left out.
        ranks = [range(min(probes, w)) for w in self.widths]
        self.choices = [c for c in itertools.product(*ranks) if math.prod(r + 1 for r in c) <= probes]

    @staticmethod
    def hadamard(x: np.ndarray) -> np.ndarray:
        """Fast Walsh-Hadamard transform of the rows."""
        size, half = x.shape[1], 1
        while half < size:
            pairs = x.reshape(len(x), size // (2 * half), 2, half)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), size)
            half *= 2
        return x / np.sqrt(size)

    def buckets(self, x: np.ndarray) -> np.ndarray:
        """Rows x tables x probes of bucket numbers, a vector's own first; unit vectors in the rows of x."""
        padded = np.zeros((len(x), self.size))
        padded[:, :x.shape[1]] = x
        out = np.zeros((len(x), self.tables, self.probes), dtype=np.int64)
        choices = self.choices
        for t in range(self.tables):
            numbers, losses = [], []
            for f, width in enumerate(self.widths):
                y = padded
                for signs in self.signs[t, f]:
                    y = self.hadamard(y * signs)
                y = y[:, :width]
                top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :self.probes]
                value = np.take_along_axis(y, top, axis=1)
                numbers.append(2 * top + (value < 0))
                losses.append((np.abs(value[:, :1]) - np.abs(value)) ** 2)
            loss = np.stack([sum(losses[f][:, c[f]] for f in range(self.functions)) for c in choices], axis=1)
            picked = np.argsort(loss, axis=1, kind="stable")[:, :self.probes]
            codes = np.zeros((len(x), len(choices)), dtype=np.int64)
            for k, c in enumerate(choices):
                for f, width in enumerate(self.widths):
                    codes[:, k] = codes[:, k] * (2 * width) + numbers[f][:, c[f]]
            out[:, t] = np.take_along_axis(codes, np.pad(picked, ((0, 0), (0, self.probes - picked.shape[1])), mode="edge"), axis=1)
        return out


def _valid(vector) -> np.ndarray | None:
    """The vector in double precision; None if it links with nothing."""
    if vector is None or not len(vector) or any(v is None for v in vector):
        return None
    x = np.array(vector, dtype=np.float64)
    return x if np.isfinite(x).all() and x.any() else None


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _vectors(table: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """One row for each id: its vector as bytes of doubles (null if it links with nothing) and its class."""
    schema = pa.schema([("id", pa.int64()), ("label", pa.string()), ("vec", pa.binary()), ("cls", pa.int64())])

    def make():
        def work(batch):
            ids, labels, vecs, classes = batch.column("id").to_pylist(), batch.column("label").to_pylist(), [], []
            for i, label_, v in zip(ids, labels, batch.column("vec").to_pylist()):
                x = _valid(v) if label_ is not None and i is not None else None
                vecs.append(None if x is None else x.tobytes())
                classes.append(None if x is None else xxhash.xxh3_64_intdigest(label_.encode() + b"\0" + vecs[-1]) - (1 << 63))
            return batch_of(schema, [ids, labels, vecs, classes])
        return work

    source = table.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
                          F.col(f"`{vector}`").cast("array<double>").alias("vec"))
    rows = map_arrow(source, make, "id long, label string, vec binary, cls long")
    known = rows.filter("id is not null").groupBy("id").agg(F.min(F.struct("label", "vec", "cls")).alias("v")).select("id", "v.*")
    return known.union(rows.filter("id is null").select("id", "label", "vec", "cls"))


def _entries(classes: DataFrame, largest: int) -> DataFrame:
    """A row for each class and bucket that it stands in or is looked up in; `largest` is the number of classes of a label at most."""
    schema = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("tab", pa.int32()), ("bucket", pa.int64()), ("cls", pa.int64()),
                        ("rows", pa.int64()), ("vec", pa.binary()), ("codes", pa.binary())])

    def make():
        hashes: dict[int, CrossPolytope] = {}

        def work(batch):
            columns = {c: batch.column(c).to_pylist() for c in ("label", "cls", "rows", "vec")}
            sizes = np.array([len(v) // 8 for v in columns["vec"]])
            for dim in np.unique(sizes).tolist():
                h = hashes.get(dim) or hashes.setdefault(dim, CrossPolytope(dim, largest))
                rows = np.flatnonzero(sizes == dim)
                for part in np.array_split(rows, -(-len(rows) // 500)):
                    x = unit(np.frombuffer(b"".join(columns["vec"][i] for i in part), dtype=np.float64).reshape(len(part), dim))
                    codes = h.buckets(x)
                    made = []
                    for k, i in enumerate(part):
                        raw = codes[k].tobytes()
                        made += [(columns["label"][i], dim, t, b, columns["cls"][i], columns["rows"][i], columns["vec"][i], raw)
                                 for t in range(h.tables) for b in dict.fromkeys(codes[k, t].tolist())]
                    yield batch_of(schema, list(zip(*made)))
        return work

    return map_arrow(classes, make, "label string, dim int, tab int, bucket long, cls long, rows long, vec binary, codes binary")


def compare(tab: int, bucket: int, cls: np.ndarray, rows: np.ndarray, x: np.ndarray, codes: np.ndarray, side: np.ndarray | None,
            threshold: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each row of a bucket that count here, and a forest of them. With `side`, only pairs of different sides."""
    links, forest, parent = np.zeros(len(x), dtype=np.int64), [], list(range(len(x)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for start in range(0, len(x), 256):
        near = x[start:start + 256] @ x.T >= threshold
        a, b = np.nonzero(near)
        a = a + start
        keep = a < b if side is None else (a < b) & (side[a] != side[b])
        a, b = a[keep], b[keep]
        for part in range(0, len(a), 50_000):
            i, j = a[part:part + 50_000], b[part:part + 50_000]
            first_i, first_j = codes[i, :, 0], codes[j, :, 0]
            at_i = (first_i[:, :, None] == codes[j]).any(axis=2)  # j is looked up, or stands, where i stands
            at_j = (first_j[:, :, None] == codes[i]).any(axis=2)
            none = np.iinfo(np.int64).max
            where = np.minimum(np.where(at_i, first_i, none), np.where(at_j, first_j, none))
            first_tab = (at_i | at_j).argmax(axis=1)
            here = (at_i | at_j).any(axis=1) & (first_tab == tab) & (where[np.arange(len(i)), first_tab] == bucket)
            i, j = i[here], j[here]
            np.add.at(links, i, rows[j])
            np.add.at(links, j, rows[i])
            for p, q in zip(i.tolist(), j.tolist()):
                r, s = root(p), root(q)
                if r != s:
                    parent[r] = s
                    forest.append((int(cls[p]), int(cls[q])))
    return links, forest


def dedup(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """Per vector: its id, `n_links`, `component_id` (smallest id reachable) and `kept`."""
    vectors = materialize(_vectors(table, vec_id, vector, label), "vectors")
    classes = vectors.filter("cls is not null").groupBy("cls").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows"), F.first("label").alias("label"), F.first("vec").alias("vec"))
    classes = materialize(classes, "vector-classes")
    key = ["label", "dim", "tab", "bucket"]
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    entries = _entries(classes.select("label", "cls", "rows", "vec"), largest)
    entries = materialize(entries, "vector-buckets")
    # Buckets with one row are of no use; those above BLOCK rows are cut. Both are counted on the keys alone.
    sizes = materialize(entries.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                        .select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "bucket-sizes")
    cut = entries.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    task = [*key, "i", "j"]
    ordered = cut.repartition(*[F.col(c) for c in task]).sortWithinPartitions(*task, "cls").select(*task, "block", "cls", "rows", "vec", "codes")
    schema = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])

    def run(batches):
        held: list = []

        def finish():
            if len(held) < 2:
                return None
            (_, _, tab, bucket, i, j), found = held[0][0], [h[1:] for h in held]
            cls, rows = np.array([h[1] for h in found]), np.array([h[2] for h in found])
            x = unit(np.frombuffer(b"".join(h[3] for h in found), dtype=np.float64).reshape(len(found), -1))
            codes = np.frombuffer(b"".join(h[4] for h in found), dtype=np.int64).reshape(len(found), -1, PROBES)
            side = None if i == j else np.array([h[0] for h in found])
            links, forest = compare(tab, bucket, cls, rows, x, codes, side, threshold)
            some = np.flatnonzero(links)
            made = [(int(cls[k]), int(links[k]), None) for k in some] + [(a, 0, b) for a, b in forest]
            return batch_of(schema, list(zip(*made))) if made else None

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*task, "block", "cls", "rows", "vec", "codes")]
            for values in zip(*columns):
                if held and held[0][0] != values[:6]:
                    made = finish()
                    held.clear()
                    if made is not None:
                        yield made
                held.append((values[:6], *values[6:]))
        made = finish()
        if made is not None:
            yield made

    found = materialize(ordered.mapInArrow(tidy(run), "cls long, links long, other long"), "vector-links")
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    joined = components(found.filter("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    named = classes.select("cls", "rep", "rows").join(joined.select(F.col("id").alias("cls"), "component"), "cls", "left")
    names = named.groupBy("component").agg(F.min("rep").alias("name")).filter("component is not null")
    by_class = named.join(names, "component", "left").join(counts, "cls", "left").select(
        "cls", F.coalesce("name", "rep").alias("name"), (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = vectors.select("id", "cls").join(by_class, "cls", "left")
    component = F.coalesce("name", "id")
    return out.select(F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
