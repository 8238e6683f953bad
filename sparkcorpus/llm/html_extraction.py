"""Main text of web pages by the consensus of their host.

Each page is cut into text blocks under the containers (body, article, div, ...) that hold them. Parts that are no text
by tag, role or class (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments) are left out at
once. A page votes for one container: the outermost article or main element that holds nearly all of the page's text
outside links, else the innermost container that holds it together with the page's heading. Containers go by their
generalised path, tags with classes without digits, so pages of one host vote for the same thing; Spark counts the
votes. Every page is then extracted again with its host's winning paths: all blocks under the first of them that the
page has. A page that has none uses its own container.

Votes are one small row per page. The paths of a host, at most ten (those with a tenth of the leader's votes or more,
most votes first), are joined to the pages as a written table whose size Catalyst sees.

Nulls and pages without text give an empty text; a null or odd url belongs to the host ''. Ties between paths go to
the shorter, then the lower one. Repeated pages are extracted alike and vote each. Other columns pass through; an
empty table gives an empty one. Whole pages are read, and nothing of a chosen container is capped.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkcorpus.llm.common import as_bytes, map_batches, save, whole_row

SHARE = 0.8
MAX_PATHS = 10
#: Elements nested deeper than this count to the container and the path at this depth.
MAX_DEPTH = 64

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg math xmp noembed noframes object select".split())
_CONTAINERS = frozenset("body article main section div td center blockquote".split())
_NEVER_NOISE = frozenset("html body article main".split())
_NOISE_TAGS = frozenset("head nav aside footer menu dialog button fieldset".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner banners cookie "
    "cookies consent gdpr notice notices notification alert newsletter subscribe subscription signup sidebar sidebars "
    "aside menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar toolbar comment comments "
    "commentlist disqus respond replies share sharing social related recommended recommendations popup modal overlay "
    "pager pagination widget widgets login search skip".split()
)
#: Names that also head parts of an article ("related-work"): noise only alone or beside a word for a list of links.
_DOUBTFUL = frozenset("related social search share sharing notice notices banner skip".split())
_LISTS = frozenset("post posts article articles story stories link links list item items box bar block icon icons button buttons media form".split())
_LAYOUT_WORDS = frozenset("with has no without wrapper container layout content".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"<]*"|'[^'<]*'|["'])*+)>""", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[-_]+")


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(text)} if "=" in text else {}


def _is_noise(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    if tag in _NEVER_NOISE:
        return False
    if tag in _NOISE_TAGS or (tag == "header" and not in_article):
        return True
    if attributes.get("role") in _NOISE_ROLES:
        return True
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = [p for p in _PARTS.split(_DIGITS.sub("", name)) if p]
        if not parts or _LAYOUT_WORDS.intersection(parts) or not (parts[0] in _NOISE_WORDS or parts[-1] in _NOISE_WORDS):
            continue
        if not in_article or not _DOUBTFUL.intersection(parts) or all(p in _NOISE_WORDS | _LISTS for p in parts):
            return True
    return False


class Page:
    """Text blocks of a page, each with its containers; `paths` are the containers' generalised paths."""

    def __init__(self, html: str):
        self.paths: list[str] = ["body"]
        self.tags: list[str] = ["body"]
        self.blocks: list[tuple[str, int, bool, tuple[int, ...]]] = []
        self._in_form: list[bool] = []
        self._stack: list[tuple[str, int, bool, str]] = []  # tag, container or -1, noise, generalised path
        self._open: list[int] = [0]
        self._noise = 0
        self._links = 0
        self._forms = 0
        self._words: list[str] = []
        self._linked = 0
        self._parse(html)
        self._drop_forms()

    def _drop_forms(self) -> None:
        """Forms go, unless they hold most of the page's text: then the page was put into one."""
        own = [sum(b[1] for b, inside in zip(self.blocks, self._in_form) if inside == form) for form in (False, True)]
        if own[1] <= own[0]:
            self.blocks = [b for b, inside in zip(self.blocks, self._in_form) if not inside]

    def _flush(self, heading: bool = False) -> None:
        text = " ".join("".join(self._words).split())
        if text:
            self.blocks.append((text, max(0, len(text) - self._linked), heading, tuple(self._open)))
            self._in_form.append(self._forms > 0)
        self._words, self._linked = [], 0

    def _pop(self) -> None:
        tag, container, noise, _ = self._stack.pop()
        if container >= 0:
            self._open.pop()
        self._noise -= noise
        self._links -= tag == "a"
        self._forms -= tag == "form"

    def _close(self, tags: set[str], within: frozenset[str]) -> None:
        """Close the nearest open element of these tags, unless an element of `within` lies between."""
        for i in range(len(self._stack) - 1, -1, -1):
            tag = self._stack[i][0]
            if tag in tags:
                while len(self._stack) > i:
                    self._pop()
                return
            if tag in within:
                return

    def _start(self, tag: str, text: str) -> None:
        if tag not in _INLINE:
            self._flush()
            self._close({"p"}, _CONTAINERS | {"li", "td", "th", "table"})
            if tag in _CLOSES:
                self._close(_CLOSES[tag], frozenset(["ul", "ol", "dl", "table", "select"]))
        if tag in _VOID or text.endswith("/") and tag in _RAW:
            return
        attributes = _attributes(text)
        noise = tag not in _INLINE and _is_noise(tag, attributes, any(s[0] in ("article", "main") for s in self._stack))
        parent = self._stack[-1][3] if self._stack else ""
        if tag in _INLINE or len(self._stack) >= MAX_DEPTH:
            path = parent
        else:
            classes = sorted({c for c in _DIGITS.sub("", attributes.get("class", "")).split()})
            path = "/".join(filter(None, [parent, ".".join([tag, *classes])]))
        container = -1
        if tag in _CONTAINERS and tag != "body" and len(self._stack) < MAX_DEPTH:
            container = len(self.paths)
            self.paths.append(path)
            self.tags.append(tag)
            self._open.append(container)
        self._noise += noise
        self._links += tag == "a"
        self._forms += tag == "form"
        self._stack.append((tag, container, noise, path))

    def _end(self, tag: str) -> None:
        if tag in _INLINE:
            self._close({tag}, _CONTAINERS | {"li", "td", "th", "p", "table"})
            return
        self._flush(tag == "h1")
        if tag not in ("body", "html"):
            self._close({tag}, frozenset() if tag in _CONTAINERS | _NOISE_TAGS | {"form"} else _CONTAINERS | _NOISE_TAGS | {"form"})

    def _text(self, raw: str) -> None:
        if raw and not self._noise:
            text = unescape(raw) if "&" in raw else raw
            self._words.append(text)
            if self._links:
                self._linked += len(text.strip())

    def _parse(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            found = _TAG.search(html, at)
            if not found:
                self._text(html[at:])
                break
            self._text(html[at : found.start()])
            at = found.end()
            tag = found.group(2)
            if tag is None:
                continue
            tag = tag.lower()
            if found.group(1):
                self._end(tag)
            elif tag in _RAW:
                if tag not in _INLINE:
                    self._flush()
                if not found.group(3).endswith("/"):
                    close = re.compile(rf"</{re.escape(tag)}[^>]*>", re.IGNORECASE).search(html, at)
                    at = close.end() if close else end
            else:
                self._start(tag, found.group(3))
        self._flush()

    def vote(self) -> str | None:
        """The path of the container that the page votes for."""
        chars, headed = [0] * len(self.paths), [False] * len(self.paths)
        for text, own, heading, containers in self.blocks:
            for c in containers:
                chars[c] += own
                headed[c] |= heading
        total = chars[0]
        if not self.blocks:
            return None
        enough = [c for c in range(len(chars)) if chars[c] >= SHARE * total and (total or c == 0)]
        if semantic := [c for c in enough if self.tags[c] in ("article", "main")]:
            return self.paths[semantic[0]]
        if headed[0] and (with_heading := [c for c in enough if headed[c]]):
            return self.paths[with_heading[-1]]
        return self.paths[enough[-1]]

    def text(self, winners: list[str]) -> str:
        """All blocks under the first winning path under which the page has text of its own, else under its own choice."""
        known = {self.paths[c] for _, own, _, containers in self.blocks if own for c in containers}
        path = next((p for p in winners if p in known), None) or self.vote()
        chosen = {i for i, p in enumerate(self.paths) if p == path}
        return " ".join(text for text, _, _, containers in self.blocks if not chosen.isdisjoint(containers))


def ballots(pages: DataFrame, url: str, html: str) -> DataFrame:
    """`host` and the `path` that each page with text votes for."""

    def cast(batch: pa.RecordBatch):
        paths = [Page(h.decode("utf-8", "replace")).vote() for h in as_bytes(batch.column(1))]
        voted = pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.string())], names=["host", "path"])
        yield voted.filter(pc.is_valid(voted.column(1)))

    return map_batches(pages.select(host_of(url).alias("host"), F.col(html).alias("html")), "host string, path string", cast)


def texts(html: str | Column, winners: str | Column) -> Column:
    """The main text of each page by its host's winning paths."""

    def of(pages: pa.Array, paths: pa.Array) -> pa.Array:
        pairs = zip(as_bytes(pages), paths.to_pylist(), strict=True)
        return pa.array([Page(h.decode("utf-8", "replace")).text(w or []) for h, w in pairs], pa.string())

    return F.arrow_udf(of, "string")(html, winners)


def host_of(url: str | Column) -> Column:
    host = F.lower(F.regexp_extract(F.col(url) if isinstance(url, str) else url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.coalesce(host, F.lit(""))


def consensus(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """One row per host: its winning `paths`, most votes first."""
    counted = ballots(pages, url, html).groupBy("host", "path").agg(F.count("*").alias("n"))
    order = [F.col("n").desc(), F.length("path"), F.col("path")]
    of_host = Window.partitionBy("host")
    ranked = counted.withColumn("lead", F.max("n").over(of_host)).filter(F.col("n") * MAX_PATHS >= F.col("lead"))
    ranked = ranked.withColumn("place", F.row_number().over(of_host.orderBy(*order))).filter(F.col("place") <= MAX_PATHS)
    listed = F.array_sort(F.collect_list(F.struct("place", "path")))
    return ranked.groupBy("host").agg(F.transform(listed, lambda x: x["path"]).alias("paths"))


def extract(pages: DataFrame, url: str = "url", html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Every row (or the columns to keep) as struct `row` with its main `text`."""
    winners = save(consensus(pages, url, html).select(F.col("host").alias("_host"), "paths"), "host-paths")
    rows = pages.select(whole_row(pages, keep), F.col(html).alias("_html"), host_of(url).alias("host"))
    joined = rows.join(winners, F.col("host") == F.col("_host"), "left")
    return joined.select("row", texts("_html", "paths").alias("text"))
