import hashlib

import pytest
from conftest import clashing

from meshroad.llm import html_text, merkle


def text_of(html):
    return html_text.Page().read(html).text()


@pytest.mark.parametrize("html, want", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\n\nb"),
    ("<article><h1>T</h1><p><b>one<br><p>two\n  three</p></article><footer>f</footer>", "T\n\none\n\ntwo three"),
    ("<head><title>t</title><script>var x='</p><p>no';</script><style>p{}</style></head><nav><ul><li>m</ul></nav><div class='ad'>buy</div><p>yes", "yes"),
    ("<body><header>h</header><aside>s</aside><div class='cookie-notice'>c</div><form>f<input></form><p>text</p><div id=comments><p>first!</p></div></body>", "text"),
    ("<main><p>x &lt;b&gt; &eacute;&#8364; &nbsp; y</p><!-- no --></main>", "x <b> é€ y"),
    ("<article>t<div class='share-buttons'>no</div><ul><li>i<li>j</ul></article><p>outside</p>", "t\n\ni\n\nj"),
    ("<article><p>cut off in the mid", "cut off in the mid"),
    ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</table>", "a b\n\nc"),
])
def test_main_text(html, want):
    assert text_of(html) == want


def test_repeated_branches_have_no_importance_and_go(spark):
    rows = [(i, f"http://h.example/{i}", f"<body><div class='bar'>the same everywhere</div><div class='body'><p>text {i} of this page</p></div></body>") for i in range(30)]
    rows += [(100, "http://lone.example/", "<div class='bar'>the same everywhere</div>"), (101, None, None), (102, "", ""), (102, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    nodes = {r.path: r for r in html_text.style_tree(pages.selectExpr("'h' as _host", "html as _html").limit(30)).collect()}
    assert nodes[">body.>div.bar"].importance < 0.01 < 0.85 < nodes[">body.>div.body"].importance
    got = sorted((r.page_id, r.text) for r in html_text.extract(clashing(pages)).collect())
    assert got[:30] == [(i, f"text {i} of this page") for i in range(30)]
    assert got[30:] == [(100, "the same everywhere"), (101, ""), (102, ""), (102, "")]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_very_long_page(spark):
    html = "<article>" + "".join(f"<p>paragraph {i}</p>" for i in range(50_000)) + "</article>"
    row = html_text.extract(spark.createDataFrame([(1, "http://x/", html)], "page_id long, url string, html string")).first()
    assert row.text == "\n\n".join(f"paragraph {i}" for i in range(50_000))


def test_query_equals_a_plain_reading_of_the_article(spark, sf_dir):
    import html as h
    import re

    from meshroad.llm.queries import QUERIES

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op3_html"](spark, sf_dir).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(h.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_fingerprints_and_edits():
    text = "\n".join(f"Paragraph {i} has a few words. And {i * 7} more of them, {'x' * (i % 40)}." for i in range(60))
    changed = text.replace("Paragraph 30 has", "Paragraph 30 had")
    a, b = merkle.fingerprint(text), merkle.fingerprint(changed)
    assert merkle.fingerprint(text) == a != b and merkle.likeness(a, a) == 1.0 and 0.9 < merkle.likeness(a, b) < 1.0
    (start, end), = merkle.edits(a, b)
    assert text[start:end] == "has " and start == text.index("30 has") + 3
    assert merkle.edits(a, a) == [] and merkle.likeness(merkle.fingerprint(""), merkle.fingerprint(None)) == 1.0
    assert merkle.likeness(a, merkle.fingerprint("")) == 0.0
    assert len({merkle.fingerprint(t).split(".")[0] for t in ("", " ", "\n", "a", "a\n", "a\n\n", "\na", "a b", "a  b", "A")}) == 10


@pytest.mark.parametrize("rows_a_part", [2, 1000])
def test_neighbour_edits_equal_brute_force(spark, edge_docs, rows_a_part):
    got = merkle.with_neighbour_edits(clashing(edge_docs), rows_a_part=rows_a_part).collect()
    rows = [(r.doc_id, r.text or "") for r in edge_docs.collect()]
    assert len(got) == len(rows)
    assert sorted(repr(r.doc_id) for r in got) == sorted(repr(i) for i, _ in rows)
    # Ids that stand alone and are followed by one that does: the next document is known.
    order = [9, 8, 7, 7, 6, 6, 5, 4, 3, 2, 1, None]
    texts = dict(rows)
    for i, after in ((9, 8), (5, 4), (4, 3), (3, 2), (2, 1), (1, None), (None, 9)):
        r, = [x for x in got if x.doc_id == i]
        text, nxt = texts[i], texts[after]
        edited = text[:len(text) - len(text) // 2] + nxt[:len(text) // 2]
        assert order.count(i) == 1 and r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == merkle.fingerprint(text) and r.edited_fingerprint == merkle.fingerprint(edited)
        assert r.near_edited == merkle.likeness(r.fingerprint, r.edited_fingerprint) and r.near_next == merkle.likeness(r.fingerprint, merkle.fingerprint(nxt))


def test_neighbour_edits_of_few_documents(spark, no_docs, edge_docs):
    assert merkle.with_neighbour_edits(no_docs).count() == 0
    r, = merkle.with_neighbour_edits(edge_docs.filter("doc_id = 1")).collect()
    text = "The cat sat on the mat and the dog ran."
    assert r.edited_sha256 == hashlib.sha256((text[:20] + text[:19]).encode()).hexdigest()


def extracted(spark, pages):
    rows = [(i, f"https://{host}/p{i}", html) for i, (host, html) in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return [r.text for r in html_text.extract(df, keep=["page_id"]).orderBy("page_id").collect()]


def test_repeated_pages_keep_their_article(spark):
    page = "<html><body><div class='top'><a>Home</a></div><div class='wrap'><article><h1>Title</h1><p>Story {}.</p></article></div></body></html>"
    texts = extracted(spark, [("one.org", page.format(1))] * 30 + [("two.org", page.format(k % 2)) for k in range(30)])
    assert texts == ["Title\n\nStory 1."] * 30 + [f"Title\n\nStory {k % 2}." for k in range(30)]
    plain = "<body><div class='menu-bar'>Home News</div><div class='story'><p>Story {}.</p></div></body>"
    assert extracted(spark, [("three.org", plain.format(1))] * 30) == ["Story 1."] * 30


def test_names_inside_an_article(spark):
    page = ("<article><div class='entry-header'><h1 class='header'>Title</h1></div><p class='notice'>Mind this.</p><section class='related work'>Others did "
            "<a class='share'>this</a>.</section><div class='comments'>first!</div><div class='ad'>buy</div></article>")
    assert extracted(spark, [("a.org", page)]) == ["Title\n\nMind this.\n\nOthers did this."]


def test_the_tree_decides_on_pages_without_an_article(spark):
    page = ("<body><div class='top' id='post-{0}'><ul class='x'><li>Home</li><li>News</li></ul></div><div class='post-{0} text'><p>Story number {0} of many.</p>"
            "<p>It goes on {1}.</p></div><div class='end'><p>All rights reserved</p></div></body>")
    got = extracted(spark, [(f"h{k % 3}.org", page.format(k, k * k)) for k in range(60)])
    assert got == [f"Story number {k} of many.\n\nIt goes on {k * k}." for k in range(60)]


def test_deep_nesting_takes_linear_time():
    import time

    start = time.process_time()
    assert html_text.Page(observe=True).read("<div><p>" * 25_000 + "text").text() == "text"
    assert time.process_time() - start < 20


def test_likeness_is_that_of_the_order():
    import random

    rnd = random.Random(2)
    lines = [" ".join(f"w{rnd.randrange(300)}" for _ in range(12)) for _ in range(200)]
    text, moved = "\n".join(lines), "\n".join(rnd.sample(lines, len(lines)))
    f = merkle.fingerprint
    assert merkle.likeness(f(text), f(text)) == 1.0 and merkle.likeness(f(""), f("")) == 1.0 and merkle.likeness(f(""), f("a")) == 0.0
    assert merkle.likeness(f(text), f(moved)) < 0.5
    one = "\n".join([*lines[:77], "another line", *lines[78:]])
    assert 0.97 < merkle.likeness(f(text), f(one)) < 1.0 and merkle.likeness(f(one), f(text)) == merkle.likeness(f(text), f(one))
    half = "\n".join(lines[:100] + [" ".join(f"v{rnd.randrange(300)}" for _ in range(12)) for _ in range(100)])
    assert 0.45 < merkle.likeness(f(text), f(half)) < 0.55


def test_edited_texts_are_nearer_than_the_next_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = merkle.with_neighbour_edits(docs.select("doc_id", "text")).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(texts, reverse=True)
    following = dict(zip(order, [*order[1:], order[0]]))
    for r in rows:
        t, n = texts[r.doc_id], texts[following[r.doc_id]]
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        assert r.near_edited == pytest.approx(merkle.likeness(r.fingerprint, merkle.fingerprint(edited)))
        assert len(t) <= 200 or t == n or r.near_edited > r.near_next, (r.doc_id, r.near_edited, r.near_next)
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1


def test_a_line_is_hashed_once_for_a_text_and_its_edited_text(monkeypatch):
    text, following = ("\n".join(f"{name} line {i} of the text." for i in range(40)) for name in ("one", "next"))
    known, made, paragraph = {}, [], merkle._paragraph
    monkeypatch.setattr(merkle, "_paragraph", lambda line: made.append(line) or paragraph(line))
    marks = [merkle.fingerprint(t, known) for t in (text, following, merkle.edited(text, following))]
    assert len(made) <= 82  # the edited text adds the two lines that were cut
    assert marks == [merkle.fingerprint(t) for t in (text, following, merkle.edited(text, following))]
    assert merkle.likeness(merkle.opened(marks[0]), merkle.opened(marks[2])) == merkle.likeness(marks[0], marks[2])
