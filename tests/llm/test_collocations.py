import random
import re
from collections import Counter

import pytest
from conftest import DOCUMENTS, clashing

from meshroad.llm import collocations as c


def plain(rows, least, top):
    """The contract read literally; rows are (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang, text = lang if lang is not None else "und", text or ""
        text = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            totals[lang] += len(words)
            for n in range(1, 6):
                counts.setdefault(lang, Counter()).update(words[i:i + n] for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: k for p, k in f.items() if len(p) > 1 and k >= least}
        held = Counter()  # the largest count of a longer candidate that holds the phrase
        for q, k in candidates.items():
            for p in {q[i:j] for i in range(len(q)) for j in range(i + 2, len(q) + 1)} - {q}:
                held[p] = max(held[p], k)
        found = []
        for p, a in candidates.items():
            if 100 * held[p] >= 100 * a:
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, totals[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def random_rows(seed, n=80):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "x\x01", "x", "\x00", "cat", "sat", "on", "mat", "é", "É", "\U0001f600", " ", "b-c"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "! ?", ";:"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words[:rng.randrange(1, 17)]) + rng.choice(ends) for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), rng.choice([text, text, text + "the cat sat on the mat the cat sat on the mat", None])))
    return rows


def mined(df, **more):
    return sorted(tuple(r) for r in c.mine(df, **more).collect())


@pytest.mark.parametrize("least, top, gather", [(4, 2000, 2_000_000), (2, 7, 50)])
def test_equals_a_plain_version(spark, monkeypatch, least, top, gather):
    monkeypatch.setattr(c, "GATHER_BYTES", gather)
    monkeypatch.setattr(c, "REMEMBER", 5)
    rows = random_rows(least)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = mined(df, least=least, top=top)
    assert len(got) > 10
    assert got == plain(rows, least, top)


def test_full_maps_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(c, "LEAST_BITS", 16)
    monkeypatch.setattr(c, "MOST_BITS", 16)
    rows = random_rows(3, 40)
    full = [("en", f"w{k} v{k}") for k in range(3)] * 4
    df = spark.createDataFrame(rows + full, "lang string, text string")
    monkeypatch.setattr(c, "_has", lambda bits, hashes: hashes == hashes)
    assert mined(df, least=4) == plain(rows + full, 4, 2000)


def test_edges(spark, edge_docs, edge_rows):
    assert mined(clashing(edge_docs), least=2) == plain([(r[2], r[1]) for r in edge_rows], 2, 2000)
    assert mined(spark.createDataFrame([], DOCUMENTS)) == []
    assert mined(spark.createDataFrame([(1, None, None, None, None)], DOCUMENTS), least=1) == []


def test_products_past_64_bits(spark):
    big = 4_000_000_000_000
    totals = spark.createDataFrame([("en", big)], "lang string, n long")
    stream = spark.createDataFrame([("en", ["a"], big - 1), ("en", ["b"], big - 2), ("en", ["a", "b"], big - 3)], "lang string, words array<string>, f long")
    got = c.scored(totals, stream).first()
    assert got.score == 1000 * (big - 3) * big // ((big - 1) * (big - 2))
