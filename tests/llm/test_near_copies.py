import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from conftest import clashing, documents

from meshroad.llm import shingle_join, vector_dedup
from meshroad.llm.common import SHUFFLE_CLEANUP, Scratch
from meshroad.llm.components import components
from meshroad.session import scratch_dir


def words_of(text):
    w = text.encode().lower().split() if text else []
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()


def smallest(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def brute(rows):
    sets = [(i, words_of(t)) for i, t in rows]
    links = [(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[:k] if a and b and 100 * len(a & b) >= 75 * len(a | b)]
    names = smallest([i for i, _ in rows], links)
    return {i: (len(s), names[i]) for i, s in sets}


def test_components_of_a_long_path_and_a_star(spark):
    rng = np.random.default_rng(0)
    path = [(i, i + 1) for i in range(1, 200)] + [(300, 300 + k) for k in range(1, 50)] + [(7, 7), (None, 3)]
    links = [path[i] for i in rng.permutation(len(path))]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 201)}, **{i: 300 for i in range(300, 350)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def copies():
    """A group of near copies around the threshold, groups of exact copies, a passage that many texts share."""
    rng = np.random.default_rng(4)
    word = lambda n: [f"w{k}" for k in rng.integers(0, 5000, n)]
    base, passage, rows = word(120), word(30), []
    for i in range(90):
        text = list(base)
        for k in rng.integers(0, 120, rng.integers(0, 7)):
            text[k] = word(1)[0]
        rows.append(" ".join(text))
    rows += [" ".join(word(60))] * 5 + [" ".join([*word(60), *passage, *word(int(k))]) for k in rng.integers(0, 60, 80)]
    rows += [" ".join([*passage, *word(int(k))]) for k in rng.integers(0, 9, 40)]
    rows += ["one two", "One\ttwo ", "one two three four five", "a b c d e f g", "a b c d e f g h", "", None, " \n"]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("short, block", [(64, 256), (8, 16), (2, 7)])
def test_links_equal_brute_force(spark, copies, monkeypatch, short, block):
    monkeypatch.setattr(shingle_join, "SHORT_LIST", short)
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    docs = documents(spark, [(i, t, "en", "s") for i, t in copies])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.join(docs).collect()}
    assert got == brute(copies)


def test_join_of_edge_rows(spark, edge_docs, no_docs):
    rows = sorted((repr(r.doc_id), r.n_shingles, r.component_id) for r in shingle_join.join(clashing(edge_docs)).collect())
    assert len(rows) == edge_docs.count()
    assert ("7", 6, 1) in rows and ("1", 6, 1) in rows and [r for r in rows if r[0] == "6"] == [("6", 4, 6)] * 2
    assert [r[1:] for r in rows if r[0] == "2"] == [(0, 2)] and [r[2] for r in rows if r[0] == "None"] == [None]
    assert shingle_join.join(no_docs).count() == 0


def test_the_bounds_lose_no_pair():
    for a in range(1, 60):
        for b in range(a, 60):
            least = shingle_join.needed(a, b)
            fits = [s for s in range(a + 1) if 100 * s >= 75 * (a + b - s)]
            assert fits == list(range(least, a + 1))


def test_divide_skip_counts_like_a_plain_count():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lists = {t: np.unique(rng.integers(0, 40, rng.integers(1, 30))) for t in range(25)}
        query = rng.permutation(25)[:15].tolist()
        counts = defaultdict(int)
        for t in query:
            for x in lists[t].tolist():
                counts[x] += 1
        for least in (1, 4, 9, 15):
            assert shingle_join.divide_skip(query, lists, least) == {x: n for x, n in counts.items() if n >= least}


@pytest.mark.parametrize("probed", [1, 3, 64])
def test_divide_skip_leaves_out_what_is_skipped(monkeypatch, probed):
    monkeypatch.setattr(shingle_join, "PROBED", probed)
    rng = np.random.default_rng(probed)
    for _ in range(60):
        lists = {t: np.unique(rng.integers(0, 40, rng.integers(1, 30))) for t in range(25)}
        query = rng.permutation(25)[:15].tolist()
        counts = Counter(x for t in query for x in lists[t].tolist())
        for least in (1, 4, 9, 15):
            assert shingle_join.divide_skip(query, lists, least, lambda x: x % 3 == 0) == {x: n for x, n in counts.items() if n >= least and x % 3}


@pytest.mark.parametrize("most_bits", [28, 20, 14])
def test_the_map_of_shared_shingles_loses_none(monkeypatch, most_bits):
    monkeypatch.setattr(shingle_join, "MOST_BITS", most_bits)
    rng = np.random.default_rng(most_bits)
    one, several, last = rng.integers(0, 1 << 60, 200_000), rng.integers(0, 1 << 60, 20_000), rng.integers(0, 1 << 60, 100) | shingle_join.LAST
    shared, held = shingle_join.SharedTokens(200_000), defaultdict(list)
    for part in (np.concatenate([one[:120_000], several, last]), np.concatenate([one[120_000:], several, several, last]), several[:0]):
        for group, low in zip(*shared.grouped(part)):
            held[group].append(low)
    shared.put({g: bits for g, low in held.items() if (bits := shared.marked(low)) is not None})
    assert shared.has(several).all() and shared.has(last).all() and not len(shared.has(several[:0]))
    assert most_bits < 20 or shared.has(one).mean() < 0.1


def test_only_shingles_of_several_classes_become_rows_of_lists(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 10 ** 9, 200)) for _ in range(100)]
    docs = spark.createDataFrame([*enumerate(texts), (1000, texts[0] + " x"), (1001, texts[0])], "_id long, _text string")
    classes = shingle_join._signatures(docs, np.zeros(0, np.int64)).dropDuplicates(["cls"]).select("cls", "n", "prefix").cache()
    found = shingle_join._postings(classes, shingle_join._shared_tokens(classes)).collect()
    prefixes = [(r.cls, r.n, np.frombuffer(r.prefix, np.int64).tolist()) for r in classes.collect()]
    counts = Counter(t for _, _, p in prefixes for t in p)
    need = {(t, cls, n, k) for cls, n, p in prefixes for k, t in enumerate(p) if counts[t] > 1}
    every = {(t, cls, n, k) for cls, n, p in prefixes for k, t in enumerate(p)}
    assert len(need) >= 80 and need <= {tuple(r) for r in found} <= every and len(found) < len(need) + 0.02 * len(every)


def test_a_join_leaves_no_large_tables_nor_shuffles(spark, copies):
    docs = documents(spark, [(i, t, "en", "s") for i, t in copies])
    blocks = lambda: {str(b) for b in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()) if str(b).startswith("shuffle_")}
    scratch, before, setting = Scratch(spark), blocks(), spark.conf.get(SHUFFLE_CLEANUP, None)
    scratch.write(docs.groupBy("text").count(), "kept")
    for _ in range(50):
        if blocks() <= before:
            break
        time.sleep(0.1)
    assert blocks() <= before and spark.conf.get(SHUFFLE_CLEANUP, None) == setting
    scratch.drop("kept")
    here = lambda: {p.name.rsplit("-", 1)[0] for p in Path(scratch_dir(spark).removeprefix("file://")).iterdir() if p.name not in there}
    there = {p.name for p in Path(scratch_dir(spark).removeprefix("file://")).iterdir()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.join(docs).collect()}
    assert got == brute(copies)
    assert here() and not here() & {"kept", "join-signatures", "join-classes", "join-lists", "join-texts", "join-long-texts", "join-members"}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute_vectors(rows, threshold):
    good = [(i, np.array(v, dtype=np.float32).astype(float), lab) for i, v, lab in rows]
    links = [(i, j) for k, (i, x, p) in enumerate(good) for j, y, q in good[:k] if p == q and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold]
    names = smallest([i for i, _, _ in good], links)
    return {i: (sum(i in pair for pair in links), names[i]) for i, _, _ in good}


@pytest.mark.parametrize("block", [1024, 16])
def test_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        base = rng.normal(size=24) if i % 4 == 0 or not rows else np.array(rows[rng.integers(0, len(rows))][1])
        rows.append((i, (base + rng.normal(size=24) * (0 if i % 7 == 0 else 0.12)).astype(np.float32).tolist(), i % 2 if i % 4 == 0 else rows[-1][2]))
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(60)]
    want = brute_vectors(rows, vector_dedup.THRESHOLD)
    got = {r.vec_id: r for r in vector_dedup.dedup(vectors(spark, rows)).collect()}
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert [got[i].n_links for i in range(1000, 1060)] == [got[0].n_links] * 60 and got[0].n_links >= 60
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


@pytest.mark.parametrize("dimension, classes", [(64, 0), (64, 20_000), (64, 1_000_000), (64, 100_000_000), (32, 1_000_000), (200, 1_000_000)])
def test_recall_at_the_threshold(dimension, classes):
    rng = np.random.default_rng(8)
    a, o = (vector_dedup.unit(rng.normal(size=(1000, dimension))) for _ in range(2))
    o = vector_dedup.unit(o - (o * a).sum(axis=1, keepdims=True) * a)
    h = vector_dedup.CrossPolytope(dimension, classes)
    x, y = h.buckets(a), h.buckets(0.93 * a + np.sqrt(1 - 0.93 ** 2) * o)
    met = ((x[:, :, :1] == y) | (y[:, :, :1] == x)).any(axis=(1, 2))
    assert met.mean() > (0.98 if classes else 0.99)


def test_buckets_grow_with_the_classes():
    met = []
    for n in (5_000, 20_000, 80_000):
        h = vector_dedup.CrossPolytope(32, n)
        assert np.prod([2 * w for w in h.widths]) >= vector_dedup.ROOM * n
        codes = h.buckets(vector_dedup.unit(np.random.default_rng(1).normal(size=(n, 32))))
        pairs = 0
        for t in range(h.tables):
            _, sizes = np.unique(codes[:, t].ravel(), return_counts=True)
            pairs += (sizes.astype(float) ** 2).sum() / 2
        met.append(pairs / n / h.tables)
    assert met[2] < 3 * met[0]  # rows that meet a vector in a table; with the same buckets it would be 16 times as many
    assert vector_dedup.CrossPolytope(3, 10**9).functions <= 3


def test_more_functions_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "ROOM", 200)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    rows = [(i, (base[i % 60] + rng.normal(size=16) * 0.15).astype(np.float32).tolist(), i % 60 % 2) for i in range(400)]
    assert vector_dedup.CrossPolytope(16, 200).functions > vector_dedup.FUNCTIONS
    want, got = brute_vectors(rows, vector_dedup.THRESHOLD), {r.vec_id: r for r in vector_dedup.dedup(vectors(spark, rows)).collect()}
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n for n, _ in want.values())


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    y = vector_dedup.CrossPolytope.hadamard(x)
    assert np.allclose((x * x).sum(axis=1), (y * y).sum(axis=1)) and np.allclose(vector_dedup.CrossPolytope.hadamard(y), x)


def test_vectors_that_link_with_nothing(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, one, 0), (2, one, 0), (2, one, 0), (3, one, 1), (4, one, None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0, 0.0], 0), (8, [1.0, None, 3.0], 0),
            (9, [1.0, float("nan"), 3.0], 0), (10, [1.0, float("inf"), 3.0], 0), (11, [1.0, 2.0], 0), (12, [2.0, 4.0, 6.0], 0), (None, one, 0)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vector_dedup.dedup(clashing(vectors(spark, rows).withColumnRenamed("label", "mark")), label="mark").collect()}
    assert {i: got.pop(i) for i in (1, 2, 12)} == {1: (2, 1, True), 2: (2, 1, False), 12: (2, 1, False)}
    assert got.pop(None) == (0, None, False)
    assert got == {i: (0, i, True) for i in got}
    assert vector_dedup.dedup(vectors(spark, [])).count() == 0
