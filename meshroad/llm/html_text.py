"""Main text of web pages with a site style tree.

The DOMs of a host's pages are merged: a node of the style tree is a path of container elements (tag and class, but for classes with digits). Over
all pages of the host it has a distribution of presentation styles (sequences of child tags) and one of contents. Its
importance is the entropy of both, as a share of the greatest possible, mixed by its number of children: a branch that
looks and reads alike on every page has importance 0, one that differs from page to page has 1. A branch of low
importance is removed, with all below it.

Entropy alone cannot judge what differs on each page without being content (advertisements, related links), nor hosts
of few pages. So the importance of a branch whose tag, role or class names its purpose is fixed: 0 for menus, headers,
footers, sidebars, notices, adverts, forms, comments, scripts and styles, 1 for `article` and `main`: a branch of low
importance does not take an article below it along. Inside an article only containers with a name of advertisements,
comments and the like go; titles and paragraphs stay whatever their class. A page with such an element keeps what is in it; any other page keeps its whole body.

The statistics are sums over (host, path, value), so a host with most of the pages is split among tasks.

Defined results: null or empty html and pages without any text give an empty text. A null url is a host of its own.
Equal pages of a host count as one page in its tree. Text outside `body` tags counts as body.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meshroad.llm.common import BROADCAST_ROWS, batch_of, field, map_arrow, materialize, with_columns_from

LEAST_PAGES = 10
LOW_IMPORTANCE = 0.2
DAMPING = 0.9
# Paths below this depth belong to their ancestor at it.
DEEPEST = 8

# Elements and names that tell a branch's purpose.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = set("script style noscript template head title iframe object svg math canvas audio video form button select "
              "textarea datalist dialog nav aside footer menu".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
CONTAINER = set("article aside body center details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
SPACE = set("br td th wbr".split())
MAIN = {"article", "main"}
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
PURPOSES = set("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
               "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted promotion "
               "related replies reply respond share sharing sidebar social sponsor sponsored subscribe subscription toolbar".split())
# Start tags that end an open paragraph or item of the same kind.
# Names that tell a purpose inside an article too, where they are on a container.
INSIDE = set("ad ads adv advert adverts advertisement advertising comments consent cookie cookies disqus modal newsletter popup promo "
             "share sharing sidebar social sponsor sponsored subscribe subscription toolbar".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
NAME = re.compile(r"[^a-z0-9]+")
# Why text is removed: its branch is alike on all pages, or its tag or name tells its purpose.
LOW, NAMED = 1, 2


class Page(HTMLParser):
    """One pass over a page; `blocks` holds its text in the order of the page."""

    def __init__(self, low: frozenset[str] = frozenset(), observe: bool = False):
        super().__init__(convert_charrefs=True)
        self.low, self.observe = low, observe
        # Element: tag, container path, why its text is removed (0: it is not), whether it is in an article or main element.
        self.stack: list[tuple[str, str, int, bool]] = [("", "", 0, False)]
        self.open_p = 0
        self.blocks: list[tuple[bool, str]] = []
        self.current: list[str] = []
        self.children: dict[str, list[str]] = {}
        self.texts: dict[str, list[str]] = {}
        self.has_main = False

    def flush(self) -> None:
        if self.current:
            text = " ".join("".join(self.current).split())
            self.current = []
            if text:
                self.blocks.append((self.stack[-1][3], text))

    def _pop_to(self, tag: str | set[str], until: set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            name = self.stack[i][0]
            if name == tag or isinstance(tag, set) and name in tag:
                self.flush_for(name)
                self.open_p -= sum(e[0] == "p" for e in self.stack[i:])
                del self.stack[i:]
                return
            if name in until:
                return

    def flush_for(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
            if self.open_p:
                self._pop_to("p", CONTAINER)
        if tag in CLOSES:
            self._pop_to(CLOSES[tag], CONTAINER)
        if tag in SPACE:
            self.handle_data(" ")
        _, path, removed, inside = self.stack[-1]
        if self.observe and path:
            seen = self.children.setdefault(path, [])
            if not seen or seen[-1] != tag:
                seen.append(tag)
        if tag in VOID:
            return
        names = dict(attrs) if attrs else {}
        classes, label = (names.get("class") or "").lower(), f"{names.get('class') or ''} {names.get('id') or ''}".lower() if names else ""
        if tag in CONTAINER and path.count(">") < DEEPEST:
            # Names with digits are those of one page.
            path = f"{path}>{tag}.{'.'.join(c for c in classes.split() if not any(d.isdigit() for d in c))}"
            if self.observe:
                self.children.setdefault(path, [])
        if tag in MAIN:
            # A branch that is alike on all pages cannot take the article below it along.
            removed = 0 if removed == LOW else removed
            inside, self.has_main = True, self.has_main or not removed
        elif not removed:
            purposes = INSIDE if inside else PURPOSES
            told = bool(label) and tag not in ("body", "html") and (tag in CONTAINER or not inside) and not purposes.isdisjoint(NAME.split(label))
            if tag in NO_TEXT or tag == "header" and not inside or (names.get("role") or "").lower() in ROLES or "hidden" in names or told:
                removed = NAMED
            elif path in self.low and tag in CONTAINER and not inside:
                removed = LOW
        self.open_p += tag == "p"
        self.stack.append((tag, path, removed, inside))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_data(" ")
        elif tag not in VOID:
            self._pop_to(tag, set() if tag in CONTAINER else CONTAINER)

    def handle_data(self, data):
        _, path, removed, _ = self.stack[-1]
        if self.observe and path:
            self.texts.setdefault(path, []).append(data)
        if not removed:
            self.current.append(data)

    def read(self, html: str) -> Page:
        self.feed(html)
        self.close()
        self.flush()
        return self

    def text(self) -> str:
        inside = [t for main, t in self.blocks if main]
        return "\n\n".join(inside if self.has_main and inside else [t for _, t in self.blocks])


def _observations(pages: DataFrame) -> DataFrame:
    """Pages by host, path, kind (presentation style or content) and value, with the number of child tags."""
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("style", pa.bool_()), ("value", pa.int64()), ("children", pa.float64()), ("n", pa.float64())])

    def make():
        def work(batch):
            rows = []
            for host, html, copies in zip(*(batch.column(c).to_pylist() for c in ("_host", "_html", "_copies"))):
                page = Page(observe=True).read(html or "")
                texts: dict[str, list[str]] = {}
                for path, parts in page.texts.items():
                    while path:  # the content of a branch is that of all below it
                        texts.setdefault(path, []).extend(parts)
                        path = path.rpartition(">")[0]
                for path, tags in page.children.items():
                    content = " ".join("".join(texts.get(path, ())).split())
                    rows.append((host, path, True, _number(" ".join(tags)), len(tags) / copies, 1 / copies))
                    rows.append((host, path, False, _number(content), len(tags) / copies, 1 / copies))
            return batch_of(schema, list(zip(*rows)) if rows else [[]] * 6)
        return work

    return map_arrow(pages, make, "host string, path string, style boolean, value long, children double, n double")


def _number(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def style_tree(pages: DataFrame) -> DataFrame:
    """Nodes of the style trees: host, path, number of pages, entropies and importance."""
    # Equal pages of a host are one page: each of n copies counts as 1/n.
    hashed = pages.withColumn("_hash", F.xxhash64("_html"))
    copies = materialize(hashed.groupBy("_host", "_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "page-copies")
    side = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies.hint("shuffle_merge")
    weighed = hashed.join(side, ["_host", "_hash"], "left").select("_host", "_html", F.coalesce("_n", F.lit(1)).alias("_copies"))
    counts = _observations(weighed).groupBy("host", "path", "style", "value").agg(F.round(F.sum("n"), 3).alias("n"), F.sum("children").alias("children"))
    sums = counts.groupBy("host", "path", "style").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("s"), F.sum("children").alias("children"))
    entropy = F.when(F.col("pages") > 1, (F.log("pages") - F.col("s") / F.col("pages")) / F.log("pages")).otherwise(1.0)
    sums = sums.withColumn("entropy", entropy)
    nodes = sums.groupBy("host", "path").agg(
        F.max("pages").alias("pages"), F.max(F.when(F.col("style"), F.col("entropy"))).alias("style_entropy"),
        F.max(F.when(~F.col("style"), F.col("entropy"))).alias("content_entropy"), (F.max("children") / F.max("pages")).alias("children"))
    content_share = F.pow(F.lit(DAMPING), F.col("children"))
    return nodes.withColumn("importance", (1 - content_share) * F.col("style_entropy") + content_share * F.col("content_entropy"))


def extract(pages: DataFrame, html: str = "html", url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """Add `text`, the page's main text: its blocks in the order of the page, joined by two line breaks."""
    columns = [c for c in (pages.columns if keep is None else keep) if c not in ("text",)]
    host = F.lower(F.regexp_extract(F.coalesce(F.col(f"`{url}`"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    source = pages.withColumn("_host", host).withColumn("_html", F.col(f"`{html}`"))
    low = (style_tree(source.select("_host", "_html")).filter((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < LOW_IMPORTANCE))
           .groupBy("host").agg(F.collect_set("path").alias("_low")).withColumnRenamed("host", "_low_host"))
    low = materialize(low, "style-tree")
    small = low.agg(F.coalesce(F.sum(F.size("_low")), F.lit(0)).alias("n")).first().n <= BROADCAST_ROWS // 10
    joined = source.join(F.broadcast(low) if small else low, F.col("_host") == F.col("_low_host"), "left")
    joined = joined.select(*[F.col(f"`{c}`") for c in columns], "_html", "_low")

    def make():
        known: dict[tuple, frozenset] = {}

        def work(arrays):
            texts = []
            for source_html, paths in zip(arrays[0].to_pylist(), arrays[1].to_pylist()):
                key = tuple(paths or ())
                if key not in known:
                    known.clear() if len(known) > 10_000 else None
                    known[key] = frozenset(key)
                texts.append(Page(known[key]).read(source_html).text() if source_html else "")
            return [pa.array(texts, pa.string())]
        return work

    return with_columns_from(joined, ["_html", "_low"], make, [field("text", T.StringType())], keep=columns)
