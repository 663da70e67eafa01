"""HTML main-text extraction by consensus host paths.

Pass one parses each page, scores its containers and casts one vote: the
generalised tag-class path of the best container.  Spark counts the votes by
(host, path) and keeps, per host, the paths with at least a tenth of its votes.
Pass two parses each page again and takes the text under the first of its
host's paths that occurs on it; a page on which none occurs takes its own best
container.

A path is the chain of block elements from the root; a step is the tag with its
classes, digits replaced by ``#``.  Inside a container, blocks below dropped
elements (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
reader comments) are left out.

Defined results: null or empty html, or html without main text, gives the empty
text; pages without a host decide for themselves; of equal scores the container
that opens first wins, of equal votes the smaller path; repeated rows vote and
are answered each; very long pages are parsed whole in time linear in their
length; an empty table gives no rows; null ids and urls are kept; further
columns are left out, whatever their names.  White space is Unicode white space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import persist, small_side, table

VOTE_SHARE = 10             # a path needs a tenth of the votes: at most ten paths a host
VOTES_HELD = 20_000         # (host, path) counters of a task before they are sent on
HOSTS_BROADCAST = 200_000
SALTS = 32                  # of the join by host when the hosts are too many to broadcast
OUT_BYTES = 8 << 20
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
VOTES = "host string, path long, label string, votes long"
RESULT = "page_id long, url string, text string"

# Elements of HTML and the words that name what is not main text.
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section
summary table tbody td tfoot th thead tr ul""".split())
HIDDEN = frozenset("""audio button canvas datalist head iframe map math noscript object picture select svg template
video""".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
DROPPED = frozenset("aside dialog footer form menu nav search".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
HINTS = frozenset("""ad ads adv advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment commentlist
comments consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices
pager pagination popup promo promotion recommended related replies reply respond share sharing sidebar signup social sponsor
sponsored subscribe toolbar widget""".split())
NEGATIONS = frozenset("has hide is no not show with without".split())
COMMENTS = frozenset("comment commentlist comments disqus replies reply respond".split())
POSITIVE = frozenset("article body content entry main post story text".split())
CONTAINERS = frozenset("article body div main section td".split())
CLOSES = {
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"),
    "tr": ("td", "th", "tr", "p"), "tbody": ("td", "th", "tr", "thead", "tbody", "p"), "tfoot": ("td", "th", "tr", "tbody", "p"),
}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_STRAY = re.compile(r"[\s/=]*")
_DIGITS = re.compile(r"\d+")
_WORDS = re.compile(r"[-_\s]+")


class Page:
    """Block elements of a page and the text blocks inside them, in page order."""

    def __init__(self):
        self.parent: list[int] = [-1]
        self.tag: list[str] = [""]
        self.step: list[str] = [""]
        self.path: list[int] = [0]
        self.drop: list[bool] = [False]
        self.liked: list[bool] = [False]
        self.blocks: list[tuple[int, str, int]] = []     # (element, text, code points in links)

    def add(self, tag: str, classes: str, parent: int, drop: bool, liked: bool) -> int:
        step = f"{tag}.{'.'.join(sorted(set(_DIGITS.sub('#', classes.lower()).split())))}" if classes else tag
        self.parent.append(parent)
        self.tag.append(tag)
        self.step.append(step)
        self.path.append(xxhash.xxh64_intdigest(step, self.path[parent]))
        self.drop.append(drop)
        self.liked.append(liked)
        return len(self.tag) - 1

    def label(self, node: int) -> str:
        steps = []
        while node > 0:
            steps.append(self.step[node])
            node = self.parent[node]
        return ">".join(reversed(steps))


def attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes of the tag whose name ends at ``at``, and the position behind
    the tag (the end of the page if the tag does not end)."""
    found: dict[str, str] = {}
    while at < len(html):
        if html[at] == ">":
            return found, at + 1
        m = _ATTRIBUTE.match(html, at)
        if m is None or m.end() == at:
            at = max(_STRAY.match(html, at).end(), at + (html[at] not in ">"))
            continue
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        at = m.end()
    return found, len(html)


def boilerplate(tag: str, attrs: dict[str, str]) -> tuple[bool, bool]:
    """(dropped, only by a class or id that may sit on a wrapper of the text)."""
    if tag in DROPPED or attrs.get("role", "").strip().lower() in ROLES:
        return True, False
    if tag in ("html", "body", "main"):
        return False, False
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        words = _WORDS.split(name)
        if words[0] not in NEGATIONS and not HINTS.isdisjoint(words):
            return True, COMMENTS.isdisjoint(words)
    return False, False


def parse(html: str) -> Page:
    """One scan of the page.  Elements that are not blocks do not shape the
    tree; end tags that match nothing are ignored."""
    page = Page()
    stack, opened = [0], {}          # open elements and how many of a tag are open
    hidden: list[str] = []           # open elements that never show text and do not end a block
    concealed: dict[str, int] = {}   # how many of a tag are among them
    doubtful: list[int] = []         # open elements dropped for their class only
    buffer: list[str] = []
    linked, in_link, articles = 0, False, 0
    at, end = 0, len(html)

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                page.blocks.append((stack[-1], text, min(linked, len(text))))
        linked = 0

    def pop() -> None:
        nonlocal articles
        node = stack.pop()
        tag = page.tag[node]
        opened[tag] -= 1
        articles -= tag in ("article", "main")
        if doubtful and doubtful[-1] == node:
            doubtful.pop()

    while at < end:
        lt = html.find("<", at)
        text = html[at:lt] if lt >= 0 else html[at:]
        if text and not hidden:
            text = unescape(text) if "&" in text else text
            buffer.append(text)
            if in_link:
                linked += len(text)
        if lt < 0:
            break
        nxt = html[lt + 1:lt + 2]
        if nxt == "!":
            if html.startswith("<!--", lt):
                short = next((s for s in ("<!-->", "<!--->") if html.startswith(s, lt)), None)
                close = html.find("-->", lt + 4)
                at = lt + len(short) if short else close + 3 if close >= 0 else end
            else:
                close = html.find(">", lt)
                at = close + 1 if close >= 0 else end
            continue
        closing = nxt == "/"
        m = _NAME.match(html, lt + 1 + closing)
        if m is None:
            if closing or nxt == "?":
                close = html.find(">", lt)
                at = close + 1 if close >= 0 else end
            else:
                if not hidden:
                    buffer.append("<")
                at = lt + 1
            continue
        tag = m[0].lower()
        attrs, at = ({}, m.end() + 1) if html[m.end():m.end() + 1] == ">" else attributes(html, m.end())
        if closing and hidden:
            if concealed.get(tag):
                last = None
                while last != tag:
                    last = hidden.pop()
                    concealed[last] -= 1
                continue
            if tag not in BLOCK or not opened.get(tag):
                continue
            hidden.clear()               # an element around the hidden one ends: so does the hidden one
            concealed.clear()
        if closing:
            if tag == "a":
                in_link = False
            elif tag in BLOCK:
                flush()
                if opened.get(tag):
                    while page.tag[stack[-1]] != tag:
                        pop()
                    pop()
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            close = html.find(">", close.end()) if close else -1
            at = close + 1 if close >= 0 else end
            continue
        if hidden:
            if tag != "body" or hidden[0] != "head":
                if tag in HIDDEN or tag in BLOCK:
                    hidden.append(tag)
                    concealed[tag] = concealed.get(tag, 0) + 1
                continue
            hidden.clear()
            concealed.clear()
        elif tag in HIDDEN:
            hidden.append(tag)
            concealed[tag] = concealed.get(tag, 0) + 1
            continue
        if tag not in BLOCK:
            if tag == "a":
                in_link = True
            elif tag == "br":
                buffer.append("\n")
            continue
        flush()
        if tag == "hr":
            continue
        closes = CLOSES.get(tag, ("p",))
        while page.tag[stack[-1]] in closes:
            pop()
        drop, doubt = boilerplate(tag, attrs)
        if tag == "header":
            drop, doubt = True, articles > 0     # the headline of an article may stand in its header
        words = set(_WORDS.split(f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()))
        node = page.add(tag, attrs.get("class", ""), stack[-1], drop, not POSITIVE.isdisjoint(words))
        if tag in ("main", "h1"):                # a wrapper of the text, whatever its class
            for other in doubtful:
                page.drop[other] = False
            doubtful.clear()
        if drop and doubt:
            doubtful.append(node)
        stack.append(node)
        opened[tag] = opened.get(tag, 0) + 1
        articles += tag in ("article", "main")
        in_link = False
    flush()
    return page


def dropped(page: Page) -> list[bool]:
    """Elements that are dropped or lie below a dropped one."""
    out = [False]
    for node in range(1, len(page.tag)):
        out.append(page.drop[node] or out[page.parent[node]])
    return out


def best_container(page: Page, gone: list[bool]) -> int | None:
    """The container with the highest score.  A block gives the code points it
    has outside links, less those inside, to its container, half as much to the
    next one up and a quarter to the third."""
    holder = [0]
    for node in range(1, len(page.tag)):
        holder.append(node if page.tag[node] in CONTAINERS else holder[page.parent[node]])
    points: dict[int, float] = {}
    for node, text, linked in page.blocks:
        if not gone[node]:
            node, share = holder[node], float(len(text) - 2 * linked)
            for _ in range(3):
                points[node] = points.get(node, 0.0) + share
                share /= 2
                if node <= 0:
                    break
                node = holder[page.parent[node]]
    best, top = None, 0.0
    for node in sorted(points):
        tag = page.tag[node]
        weight = 2.0 if tag == "article" else 1.5 if tag == "main" else 1.25 if page.liked[node] and tag != "body" else 1.0
        if points[node] * weight > top:
            best, top = node, points[node] * weight
    return best


def text_under(page: Page, gone: list[bool], chosen: list[bool]) -> str:
    """Blocks that lie in a chosen element and in no dropped one."""
    inside = [chosen[0]]
    for node in range(1, len(page.tag)):
        inside.append(chosen[node] or inside[page.parent[node]])
    return " ".join(text for node, text, _ in page.blocks if inside[node] and not gone[node])


def extract(html: str | None, paths: list[int]) -> str:
    """Main text under the first of ``paths`` that occurs outside dropped
    elements, else under the page's own best container."""
    if not html:
        return ""
    page = parse(html)
    gone = dropped(page)
    open_paths = {p for p, g in zip(page.path, gone) if not g}
    path = next((p for p in paths if p in open_paths), None)
    if path is not None:
        return text_under(page, gone, [p == path for p in page.path])
    best = best_container(page, gone)
    return "" if best is None else text_under(page, gone, [n == best for n in range(len(page.tag))])


def _signed(path: int) -> int:
    return path - (1 << 64) if path >> 63 else path


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, int], int] = {}
    labels: dict[int, str] = {}

    def out() -> pa.RecordBatch:
        rows = [(h, _signed(p), labels[p], n) for (h, p), n in counts.items()]
        counts.clear()
        labels.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.int64()))],
            names=["host", "path", "label", "votes"])

    for batch in batches:
        for host, html in zip(batch.column(0), batch.column(1)):
            html = html.as_py()
            if not html:
                continue
            page = parse(html)
            best = best_container(page, dropped(page))
            if best is None:
                continue
            key = (host.as_py(), page.path[best])
            counts[key] = counts.get(key, 0) + 1
            if key[1] not in labels:
                labels[key[1]] = page.label(best)
            if len(counts) >= VOTES_HELD:
                yield out()
    if counts:
        yield out()


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, texts, held = [], [], [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()),
                                               pa.array(texts, pa.string())], names=["page_id", "url", "text"])

        for page_id, url, html, paths in zip(*batch.columns):
            known = [p % (1 << 64) for p in paths.as_py() or ()]
            ids.append(page_id.as_py())
            urls.append(url.as_py())
            texts.append(extract(html.as_py(), known))
            held += len(texts[-1])
            if held > OUT_BYTES:
                yield out()
                ids, urls, texts, held = [], [], [], 0
        if ids:
            yield out()


def with_host(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, host); the host is lower-case, empty if the url has none."""
    url = F.col("url").cast("string")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"),
                        F.col("html").cast("string").alias("html"),
                        F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("")).alias("host"))


def host_paths(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(host, paths, labels): the paths with at least a tenth of a host's
    votes, most votes first.  Votes are counted inside the tasks and again
    before the shuffle, so a host with a third of all pages sends few rows."""
    votes = (with_host(pages).where("host <> ''").select("host", "html").mapInArrow(_vote, VOTES)
             .groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.min("label").alias("label")))
    votes = persist(spark, votes, "host-votes")
    total = votes.groupBy("host").agg(F.sum("votes").alias("total"))
    winners = votes.join(total, "host").where(F.col("votes") * VOTE_SHARE >= F.col("total"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "label", "path")))   # at most ten
    return persist(spark, winners.groupBy("host").agg(ranked.alias("r"))
                   .select("host", F.col("r.path").alias("paths"), F.col("r.label").alias("labels")), "host-paths")


def extract_main_text(spark: SparkSession, pages: DataFrame, winners: DataFrame | None = None,
                      broadcast_rows: int = HOSTS_BROADCAST) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    winners = (host_paths(spark, pages) if winners is None else winners).select("host", "paths")
    rows, side = with_host(pages), small_side(winners, broadcast_rows)
    if side is winners:      # too many hosts: pages of a hot host are dealt over salts
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        side = winners.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.join(side, ["host", "salt"], "left")
    else:
        joined = rows.join(side, "host", "left")
    return (joined.select("page_id", "url", "html", "paths").mapInArrow(_extract, RESULT)
            .withColumn("n_chars", F.length("text").cast("long")))


def op11_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(spark, table(spark, sf_dir, "pages"))
