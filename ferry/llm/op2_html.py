"""Main text of web pages by a site style tree.

Every page is parsed into a tree; the pages of one host are merged by element
path (tags with their class and id names). For each path of a host, the
presentation importance is the entropy of its child sequences over the pages
that have it, and the content importance is one minus the mean entropy of its
text blocks over those pages: a block that stands on every page has entropy 1
and says nothing, a block of one page has entropy 0. Both are combined with
weight ``GAMMA``. A path is a low-importance branch if its importance is below
``THRESHOLD`` and it stands on at least ``MIN_PAGES`` pages (however many pages
of other templates the host has), and if the host's articles as a whole are
above the threshold (so that a host of copies loses nothing); a page whose
text is all in branches keeps it.

A page's text is that of its article (else of its main element, else of its
body), without elements whose tag, role or names say that they are menus,
headers, footers, sidebars, notices, adverts, forms or comments, and without
the low-importance branches of its host. A name hides no block with the main
element or an article of weight, nor, unless it says nothing else (a notice goes
at any size), most of the page's text; inside an article or main element only
such plain names of boxes count, never those of headings, paragraphs or links;
names make a main block only where such blocks hold most of the text; and the main element's own
plain text, or all of it where it is more than the articles', stays beside an
article. Plain text flow of an article (paragraphs, headings, list items ...
directly in it) is never a branch.

The table of branches grows with the templates of a host, not with its pages,
and is joined to the pages by host.

Defined results: null or empty html gives '' and 0; html without markup is one
block; a null or odd url counts as the host ''; unclosed comments, tags and
elements end with the page; rows are treated one by one, so repeated rows give
repeated rows; an empty table gives an empty result; other columns are ignored.
Pages of any length are parsed whole, in time linear in their text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import arrow_map, materialise

# Weight of the content, threshold, least pages of a branch.
GAMMA, THRESHOLD, MIN_PAGES = 0.9, 0.3, 5

# HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math xmp noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd "
                   "label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
                   "wbr br script style svg math template noscript".split())
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol blockquote pre table tbody thead tfoot tr td th dl "
                 "dt dd figure figcaption header hgroup article main".split())
NOISE_TAG = frozenset("head nav footer aside form button select option input menu dialog canvas "
                      "object audio video map fieldset".split()) | RAW
NOISE_ROLE = frozenset("navigation banner contentinfo complementary search dialog alert "
                       "alertdialog menu menubar toolbar".split())
# Names (parts of a class or an id) that say what an element is.
NOISE_NAME = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo "
                       "promotion nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar "
                       "footer masthead topbar cookie cookies consent gdpr notice notices "
                       "notification popup modal overlay newsletter subscribe subscription share "
                       "sharing social related recommended comment comments reply replies disqus "
                       "respond toolbar pagination pager login signup search skip".split())
# Elements that a name hides inside an article, and words that say
# nothing beside a noise name.
BOX = frozenset("div section ul ol dl table aside header details center address".split())
NEUTRAL = frozenset("site page main post posts article entry blog user global primary secondary top "
                    "bottom left right upper lower first last box boxes bar block blocks widget "
                    "widgets list lists link links item items section sections wrap wrapper "
                    "container area zone slot unit units module region panel group holder form "
                    "banner button buttons btn icon icons inner outer header title row col column "
                    "grid text label small large mini big fixed sticky media body js the a x".split())
ADVERT_NAME = frozenset("ad ads adv advert adverts advertisement advertising sponsored".split())
TALK_NAME = frozenset("comment comments reply replies disqus respond".split())
OUTER_NAME = frozenset(["header", "banner", "aside"])
MAIN_NAME = frozenset("content article post entry story main".split())
# A start tag of the key closes the open elements named.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          "tbody": {"thead", "tbody", "tr", "td", "th"}}
STOPS = frozenset("ul ol dl table select article section div body html main".split())

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
NAME_PART = re.compile(r"[a-z]+")
RAW_END = {tag: re.compile(f"</{tag}(?![a-z0-9])", re.IGNORECASE) for tag in RAW}


def _only_noise(token: str) -> bool:
    """Whether a class or id names noise and nothing else."""
    parts = set(NAME_PART.findall(token))
    return not NOISE_NAME.isdisjoint(parts) and parts <= NOISE_NAME | NEUTRAL


class _Node:
    """An element. ``noise``: a noise name may hide it, ``outer`` only outside
    a main block; ``firm``: a class or id says nothing but noise, which counts
    inside articles as well (``advert``: of words, too); ``hard``: its tag or role hides it. The sums over the element
    are ``total`` (text that is not hard), ``links`` (of it, inside links),
    ``article`` (the largest article) and ``has_main``."""

    __slots__ = ("advert", "article", "chars", "children", "firm", "hard", "has_main", "hidden", "in_main", "in_named",
                 "links", "named", "near", "noise", "outer", "path", "plain", "rank", "tag", "talk",
                 "total", "up")

    def __init__(self, tag, path, up, hard):
        self.tag, self.path, self.up, self.hard = tag, path, up, hard
        self.noise = self.firm = self.advert = self.outer = self.talk = self.named = self.has_main = False
        self.hidden = self.in_main = self.in_named = False
        self.plain = True
        self.chars = self.total = self.links = self.article = self.near = self.rank = 0
        self.children: list[str] = []


class Page:
    """``blocks``: (path, rank, plain, text) in page order, rank 2 inside an
    article, 1 inside a main element, else 0; ``plain`` inside plain text
    flow. ``styles``: path -> child sequences."""

    def __init__(self, html: str):
        self.blocks: list[tuple[str, int, bool, str]] = []
        self.styles: Counter = Counter()
        self.stack = [_Node("", "", None, False)]
        self.nodes = [self.stack[0]]
        self.buffer: list[tuple[_Node, str]] = []
        self.raw: list[tuple[_Node, list[tuple[_Node, str]]]] = []
        self._parse(html)
        self._settle()

    def _flush(self) -> None:
        if self.buffer:
            owner = next(n for n in reversed(self.stack) if n.tag not in INLINE)
            self.raw.append((owner, self.buffer))
            self.buffer = []

    def _text(self, piece: str) -> None:
        node = self.stack[-1]
        if piece and not node.hard:
            piece = unescape(piece) if "&" in piece else piece
            node.chars += len(piece.strip())
            self.buffer.append((node, piece))

    def _settle(self) -> None:
        """Decide what is hidden and every block's rank, with the whole page known."""
        for n in reversed(self.nodes):
            n.total += n.chars
            if n.tag == "a":
                n.links = n.total
            if n.tag == "article" and not n.noise:
                n.article = max(n.article, n.total)
            if n.up:
                n.up.total += n.total
                n.up.links += n.links
                n.up.article = max(n.up.article, n.article)
                n.up.has_main |= n.has_main
        page, largest = self.nodes[0].total, self.nodes[0].article

        def spared(n):
            # A name does not hide the page's main element or an article of
            # weight, nor, if it may mean something else, most of the page's
            # text (unless that is links or talk). A notice goes at any size.
            return (n.has_main or (n.article and n.article * 2 >= largest)
                    or (n.total * 2 > page and not n.talk and not n.firm
                        and n.links * 2 <= n.total))

        def named_noise(n, up):
            # In an article only boxes go by their name, and only by a name
            # that says nothing else: never headings or paragraphs, and of the
            # words in them only those marked as an advert.
            if up.near == 2 or up.in_main:
                return (n.tag == "article" and n.noise
                        or n.firm and (n.tag in BOX or n.advert and n.tag in INLINE))
            return n.noise

        sums = dict.fromkeys(("all", "article", "main", "named", "named only"), 0)
        for n in self.nodes[1:]:
            up = n.up
            n.hidden = up.hidden or n.hard or ((named_noise(n, up) or (n.outer and not up.near))
                                               and not spared(n))
            n.near = 2 if n.tag == "article" else up.near or int(n.named or n.in_main)
            n.in_main |= up.in_main
            n.in_named = up.in_named or (n.named and not up.near)
            if not n.hidden:
                sums["all"] += n.chars
                sums["named"] += n.chars * n.in_named
                sums["article"] += n.chars * (n.near == 2)
                sums["main"] += n.chars * (n.near != 2 and n.in_main)
                sums["named only"] += n.chars * (n.near != 2 and n.in_named)
        # A main block with more text beside its articles than in them counts
        # like an article; named blocks only where they hold most of the text.
        main = 1 + (sums["main"] > sums["article"] > 0)
        named = (sums["named"] * 2 > sums["all"]) * (1 + (sums["named only"] > sums["article"] > 0))
        for n in self.nodes[1:]:
            n.rank = 2 if n.near == 2 else max(main * n.in_main, named * n.in_named)
            n.plain = n.rank > n.up.rank or (n.up.plain and (n.tag in FLOW or n.tag in INLINE))
        for owner, pieces in self.raw:
            text = " ".join("".join(p for n, p in pieces if not n.hidden).split())
            if text:
                # Plain text flow of the main element stays beside an article.
                beside = owner.in_main and owner.plain and sums["article"] > 0
                self.blocks.append((owner.path, 2 if beside else owner.rank, owner.plain, text))
        del self.nodes, self.raw

    def _pop(self) -> None:
        node = self.stack.pop()
        if node.children:
            kinds = [k for k, before in zip(node.children, [None, *node.children], strict=False)
                     if k != before]
            self.styles[node.path, " ".join(kinds)] += 1

    def _open(self, tag: str, attrs: str) -> None:
        names, tokens, role = [], [], ""
        if attrs:
            for m in ATTR.finditer(attrs):
                value = (m[2] or m[3] or m[4] or "").lower()
                if m[1].lower() == "role":
                    role = value.strip()
                else:
                    names += NAME_PART.findall(value)
                    tokens += value.split()
        if tag not in INLINE:
            self._flush()
            closed = CLOSES.get(tag, ())
            for k in range(len(self.stack) - 1, 0, -1):
                open_ = self.stack[k].tag
                if open_ == "p" or open_ in closed:
                    while len(self.stack) > k:
                        self._pop()
                elif open_ in STOPS:
                    break
        up = self.stack[-1]
        label = ".".join([tag, *sorted(set(names))])
        up.children.append(label)
        container = tag in ("html", "body", "main", "article")
        node = _Node(tag, f"{up.path}/{label}", up, up.hard or tag in NOISE_TAG
                     or (not container and role in NOISE_ROLE))
        node.in_main = node.has_main = tag == "main" or role == "main"
        node.talk = not TALK_NAME.isdisjoint(names)
        if tag == "article":
            node.noise = not {"comment", "comments", "reply", "ad", "advert"}.isdisjoint(names)
        elif not container:
            node.noise = not NOISE_NAME.isdisjoint(names)
            node.firm = node.noise and any(map(_only_noise, tokens))
            node.advert = not ADVERT_NAME.isdisjoint(tokens)
            node.outer = tag == "header" or not OUTER_NAME.isdisjoint(names)
            node.named = tag not in INLINE and not MAIN_NAME.isdisjoint(names)
        self.stack.append(node)
        self.nodes.append(node)

    def _close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                if tag not in INLINE or any(n.tag not in INLINE for n in self.stack[k:]):
                    self._flush()
                while len(self.stack) > k:
                    self._pop()
                return
            # An inline end tag does not reach out of its block.
            if tag in INLINE and self.stack[k].tag not in INLINE:
                return

    def _parse(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            lt = html.find("<", at)
            if lt < 0:
                self._text(html[at:])
                break
            if lt > at:
                self._text(html[at:lt])
            if html.startswith("<!--", lt):
                close = html.find("-->", lt + 4)
                at = end if close < 0 else close + 3
                continue
            nxt = html[lt + 1:lt + 2]
            if nxt in ("!", "?"):
                close = html.find(">", lt)
                at = end if close < 0 else close + 1
                continue
            m = TAG.match(html, lt)
            if m is None:
                if not (nxt.isalpha() or nxt == "/"):
                    self._text("<")  # a bare character
                    at = lt + 1
                    continue
                close = html.find(">", lt)
                at = end if close < 0 else close + 1
                continue
            at = m.end()
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
            elif tag in VOID:
                if tag == "br":
                    self._text(" ")
                elif tag == "hr":
                    self._flush()
            elif tag in ("svg", "math") and m[3].endswith("/"):
                continue  # an empty picture or formula
            else:
                self._open(tag, m[3])
                if tag in RAW:
                    close = RAW_END[tag].search(html, at)
                    at = close.start() if close else end
        self._flush()
        while self.stack:
            self._pop()

    def chosen(self, branches: frozenset = frozenset()) -> list[str]:
        """Texts of the best-ranked blocks outside the given branches."""
        best = max((b[1] for b in self.blocks), default=0)
        whole = [b for b in self.blocks if b[1] == best]
        kept = [text for path, rank, plain, text in whole
                if plain and rank or path_key(path) not in branches]
        # Copies of one page make branches of all its paths.
        return kept or [b[3] for b in whole]


def path_key(path: str) -> int:
    return xxhash.xxh3_64_intdigest(path) - (1 << 63)


def main_text(html: str | None, branches: frozenset = frozenset()) -> str:
    return "\n\n".join(Page(html).chosen(branches)) if html else ""


# The path of all blocks of a page's best rank together.
WHOLE = 0


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: a row for every path's child sequence (``style``) and one for
    every text block (``count`` on this page)."""
    schema = pa.schema([("host", pa.string()), ("path", pa.int64()), ("style", pa.int64()),
                        ("block", pa.int64()), ("count", pa.int64())])
    for batch in batches:
        rows = {f: [] for f in schema.names}

        def add(*row, rows=rows):
            for f, x in zip(schema.names, row, strict=True):
                rows[f].append(x)

        for host, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            page = Page(html or "")
            # A path counts once per page: its child sequences as one style.
            per_path: dict[str, list] = {}
            for (path, style), _ in sorted(page.styles.items()):
                per_path.setdefault(path, []).append(style)
            blocks = Counter((path_key(p), path_key(t)) for p, _, _, t in page.blocks)
            best = max((b[1] for b in page.blocks), default=0)
            whole = Counter(path_key(t) for _, r, _, t in page.blocks if r == best)
            styles = {path_key(p): path_key(" | ".join(s)) for p, s in per_path.items()}
            for p in {p for p, _ in blocks} - styles.keys():
                styles[p] = 1
            styles[WHOLE] = 1
            for p, s in styles.items():
                add(host, p, s, None, 1)
            for (p, b), n in blocks.items():
                add(host, p, None, b, n)
            for b, n in whole.items():
                add(host, WHOLE, None, b, n)
        yield pa.RecordBatch.from_pydict(rows, schema=schema)


def style_tree(pages: DataFrame) -> DataFrame:
    """``(host, path, pages, presentation, content, importance)`` from
    ``(host, html)``. All sums are taken before the shuffle, so a host with a
    third of all pages costs no single task."""
    seen = arrow_map(pages, _observe,
                     "host string, path long, style long, block long, count long")
    # Sums over pages of c and of c ln c give the entropy of a block.
    one = materialise(seen.groupBy("host", "path", "style", "block").agg(
        F.sum("count").alias("n"), F.sum(F.col("count") * F.log("count")).alias("nlogn")),
        "style-tree")
    n = F.col("n")
    of_style = one.filter("style IS NOT NULL").groupBy("host", "path").agg(
        F.sum("n").alias("pages"), F.sum(n * F.log(n)).alias("s"))
    of_block = one.filter("block IS NOT NULL").groupBy("host", "path").agg(
        F.avg(F.log(n) - F.col("nlogn") / n).alias("h"))
    m = F.log("pages")
    presentation = F.when(F.col("pages") > 1, (m - F.col("s") / F.col("pages")) / m).otherwise(1.0)
    content = F.when(F.col("pages") > 1, 1 - F.least(F.lit(1.0), F.col("h") / m)).otherwise(1.0)
    return (of_style.join(of_block, ["host", "path"]).select(
        "host", "path", "pages", presentation.alias("presentation"), content.alias("content"))
        .withColumn("importance", (1 - GAMMA) * F.col("presentation") + GAMMA * F.col("content")))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()),
                        ("n_chars", pa.int64())])
    for batch in batches:
        rows = {f: [] for f in schema.names}
        for key, url, html, branches in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = main_text(html, frozenset(branches or ()))
            for f, x in zip(schema.names, (key, url, text, len(text)), strict=True):
                rows[f].append(x)
        yield pa.RecordBatch.from_pydict(rows, schema=schema)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, ``text`` and ``n_chars``."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(f"`{url_col}`"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://"
                                               r"(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    base = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"),
                        F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").alias("html"),
                        host.alias("host"))
    tree = style_tree(base.select("host", "html"))
    whole = tree.filter(F.col("path") == WHOLE).select(
        "host", F.col("importance").alias("whole"))
    low = (tree.filter((F.col("path") != WHOLE) & (F.col("importance") < THRESHOLD)
                       & (F.col("pages") >= MIN_PAGES))
           .join(whole, "host").filter(F.col("whole") >= THRESHOLD))
    branches = materialise(low.groupBy("host").agg(F.collect_set("path").alias("branches")),
                           "style-branches")
    out = arrow_map(base.join(branches, "host", "left").select("page_id", "url", "html", "branches"),
                    _extract, "page_id long, url string, text string, n_chars long")
    return out.withColumnRenamed("page_id", id_col).withColumnRenamed("url", url_col)
