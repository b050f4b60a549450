import hashlib
import random
import re
import time

import pytest
from conftest import clashing

from meshroad.llm import pii

# The base patterns as the contract has them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def passes_luhn(number):
    total = 0
    for k, d in enumerate(reversed(number)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain(text):
    """The base spans by the contract's patterns."""
    text, found = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for order, (kind, pattern, good) in enumerate((
            ("email", EMAIL, lambda s: True), ("ip", IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
            ("card", CARD, lambda s: 12 <= len(digits(s)) <= 19 and passes_luhn(digits(s))),
            ("phone", PHONE, lambda s: 9 <= len(digits(s)) <= 15))):
        found += [(m.start(), order, kind, m.end()) for m in pattern.finditer(text) if good(m.group())]
    spans = [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]
    return [sum(s.startswith(k) for s in spans) for k in pii.BASE], spans


def random_text(rng):
    parts = ["a@b.c", "x.y+z@mail-1.example.com", "@", "..", "4111 1111 1111 1111", "4111-1111-1111-1112", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "+1 (523) 555-1055",
             "+49 30 1234567", "+1(", "0", "12", "-", " ", "()", "é", "\U0001f600", "word", "@@a.b@c.d", "a@b", ".", "+", "\n", "000000000000", "5500005555555559", "%", "_"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(1, 30)))


def test_base_spans_equal_the_plain_patterns():
    finder, rng = pii.Finder(pii.BASE), random.Random(5)
    for _ in range(20_000):
        text = random_text(rng)
        assert [f"{k}:{a}:{b}" for k, a, b, _ in finder.spans(text)] == plain(text)[1], text


def test_query_on_edges(spark, edge_docs, edge_rows):
    extra = [(20, "card 4111 1111 1111 1111, tel. +1 (523) 555-1055; a@b.co 10.0.0.1 \U0001f600 x@y.zz", None, None)]
    docs = edge_docs.union(spark.createDataFrame([(*r, None) for r in extra], edge_docs.schema))
    got = pii.report(pii.find(clashing(docs).withColumnRenamed("host", "pii"), keep=["doc_id"])).collect()
    want = sorted((str(r[0]), *plain(r[1])[0], hashlib.sha256(",".join(plain(r[1])[1]).encode()).hexdigest(), ",".join(plain(r[1])[1])) for r in edge_rows + extra)
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in got) == want
    assert sum(r.n_email for r in got) == 2
    assert pii.find(docs).columns == [*docs.columns, "pii"] and pii.report(pii.find(docs.limit(0))).count() == 0


@pytest.mark.parametrize("text", ["a" * 300_000, "a.b" * 100_000 + "@", "1" * 300_000, "1." * 200_000, "1-" * 200_000, "+1" + "(" * 300_000, "+1 (" * 80_000, "@" * 300_000, "a@b" * 100_000,
                                  "AB12" + "C " * 150_000, "AB12CDEF" * 50_000])
def test_time_grows_with_the_length(text):
    start = time.process_time()
    pii.Finder().spans(text)
    assert time.process_time() - start < 3


def test_added_kinds_and_context():
    finder = pii.Finder()
    kinds = lambda text: [(k, s) for k, _, _, s in finder.spans(text)]
    assert kinds("send to IBAN GB82 WEST 1234 5698 7654 32 please") == [("iban", 1.0)]
    assert kinds("IBAN GB83WEST12345698765432") == []
    assert kinds("my social security number is 123-45-6789.") == [("ssn", 0.7)]
    assert kinds("the part 123-45-6789 fits, 123-45-6789 too") == []
    assert kinds("pay by card 4111111111111111")[0] == ("card", 1.0)
    assert kinds("the serial 4111111111111111")[0] == ("card", 0.4)
    assert pii.luhn("79927398713") and not pii.luhn("79927398710") and pii.mod97("DE89370400440532013000")


def test_long_parts_of_an_address():
    zeros = "0" * 6_000
    assert pii.valid_ip(f"{zeros}1.0.0.{zeros}") and not pii.valid_ip(f"1{zeros}.0.0.1")


def test_masked(spark):
    df = spark.createDataFrame([(1, "write a@b.co or 10.0.0.1."), (2, None)], "id long, text string")
    assert [tuple(r) for r in pii.masked(df, keep=["id"]).orderBy("id").collect()] == [(1, "write [email] or [ip]."), (2, None)]
