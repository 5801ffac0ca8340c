"""Main text of web pages, with site templates found by recurring subtrees.

Pages are parsed into elements; every element outside the article's prose has a hash of its subtree (tags and text,
not attributes). Spark counts, per host, with how many different main texts each hash occurs, combined map-side, so
a host with a third of all pages is counted by all tasks. A subtree with at least ``MIN_PAGES`` of them is template,
however many pages the host has; copies of an article have one main text, so what belongs to it stays. (Modified
copies have several.) Templates are joined to the hashes of distinct pages, row by row, and each page gets its own;
no list grows with a host. A second parse deletes them, and what tags, roles and class names mark as menu, header,
footer, sidebar, notice, advert, form or reader comments.

What is left of the ``article`` elements and of ``main`` ones without an article (else of the page) is the text: its
blocks, each with white space as single spaces, in page order. Paragraphs and headings inside an article are never
taken for template: copies of an article share them. Inside an article a name that prose may bear, too (related,
comment, notice, share), leaves out only what recurs, consists of links for the most part or, for comments, holds a
thread's parts; headings go by no name and paragraphs by no id.

A page is read in one pass, in time linear in its length whatever its markup: open elements are found by name, and
the first tag whose quotes never close ends the reading of quotes.

Defined results: null or empty html gives an empty text; a page without url belongs to the host of no name, where
nothing counts as template; unclosed elements end with their parents; a tag without an end is text; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import load, query
from millrace.session import settle

MIN_PAGES = 5

# A quote has a meaning after an equals sign only.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_LONG_NUMBER = re.compile(r"&#0*([0-9]{8})[0-9]*;?")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe template svg math canvas object".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr figcaption article main body html".split())
_DROPPED = _RAW | frozenset("head nav footer aside form button select option menu dialog audio video label input".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
# Elements that end an open one of the same kind, unless a container in between holds it.
_SIBLING = {
    "li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
    "option": ("select",),
}
_WORDS = (
    r"ads?|advert[a-z0-9]*|adsense|sponsor[a-z0-9]*|promo[a-z0-9]*|cookies?[a-z0-9]*|consent|gdpr|notice[a-z0-9]*|notification[a-z0-9]*|popup|modal|overlay|newsletter|"
    r"subscribe[a-z0-9]*|paywall|nav[a-z0-9]*|menu[a-z0-9]*|breadcrumb[a-z0-9]*|sidebar[a-z0-9]*|widget[a-z0-9]*|footer|comment[a-z0-9]*|disqus[a-z0-9]*|repl(?:y|ies)|respond|"
    r"related|recommend[a-z0-9]*|share|sharing|social|toolbar|pagination|pager|login|signup|search[a-z0-9]*|skip"
)
_TOP = "header|masthead|banner|topbar"
# What may stand around a word in a class name that names the element itself; has-sidebar, no-menu or tag-search name a state.
_BEFORE = "site|main|page|post|entry|article|global|top|bottom|left|right|primary|secondary|sub|mobile|desktop|user|reader|mini|sticky|js|the"
_AFTER = (
    "area|bar|block|box|btns?|buttons?|container|content|form|holder|icons?|inner|links?|list|outer|panel|posts?|articles?|section|slot|"
    "top|bottom|left|right|primary|secondary|main|unit|wrap|wrapper|thread|text|title|items?|group|row|to|item|message|banner|[0-9]+"
)


def _named(words: str) -> re.Pattern:
    """Matches classes and ids one of which, as a whole, names one of ``words``."""
    return re.compile(rf"(?:^|\s)(?:(?:{_BEFORE})[_-]+)*(?>(?:{words})(?![a-z0-9]))(?:[_-]+(?>(?:{words}|{_AFTER})(?![a-z0-9])))*+(?:$|\s)", re.I)


_MARKED, _HEADING = _named(_WORDS), _named(_TOP)
# Words that alone, as a whole class or id, may as well name a part of an article.
_WEAK = re.compile(
    r"comments?|notices?|notifications?|related|recommend[a-z]*|share|sharing|social|search|widgets?|reply|replies|overlay|skip|"
    r"menu|login|signup|respond", re.I,
)
_THREAD = re.compile(r"(?:^|[\s_-])(?:authors?|avatars?|byline|reply|user(?:name)?|votes?|timestamp|permalink)(?:$|[\s_-])", re.I)
_COMMENTS = _named(r"comment[a-z0-9]*|disqus[a-z0-9]*|repl(?:y|ies)|respond")


class Page:
    """A page's events in order: ``kind`` is '<', '>' or 't'; starts know their end and their subtree's hash."""

    def __init__(self, source: str):
        self.kind: list[str] = []
        self.value: list[str] = []
        self.attrs: list[str] = []
        self.end: list[int] = []
        self.digest: list[int] = []
        self._open: list[tuple[int, str, list[bytes]]] = []
        self._depths: dict[str, list[int]] = {}
        self._roots: list[int] | None = None
        self._running: tuple[list[int], list[int], list[int]] | None = None
        self._parse(source)

    def _add(self, kind: str, value: str, attrs: str = "") -> int:
        self.kind.append(kind)
        self.value.append(value)
        self.attrs.append(attrs)
        self.end.append(-1)
        self.digest.append(0)
        return len(self.kind) - 1

    def _start(self, tag: str, attrs: str) -> None:
        if tag in _BLOCK:
            self._close_open("p", ("button", "table", "td", "th", "body", "article", "div", "section"))
        if tag in _SIBLING:
            self._close_open(tag, _SIBLING[tag])
            if tag in ("dt", "dd"):
                self._close_open("dd" if tag == "dt" else "dt", ("dl",))
        i = self._add("<", tag, attrs)
        self._depths.setdefault(tag, []).append(len(self._open))
        self._open.append((i, tag, []))
        if tag in _VOID:
            self._pop()

    def _close_open(self, tag: str, holders: tuple[str, ...]) -> None:
        own = self._depths.get(tag)
        if own and not any(above and above[-1] > own[-1] for above in map(self._depths.get, holders)):
            self._close_from(own[-1])

    def _close_from(self, depth: int) -> None:
        while len(self._open) > depth:
            self._pop()

    def _pop(self) -> None:
        i, tag, parts = self._open.pop()
        self._depths[tag].pop()
        self.end[i] = self._add(">", tag)
        digest = hashlib.blake2b(b"\0".join([tag.encode(), *parts]), digest_size=8).digest()
        self.digest[i] = int.from_bytes(digest, "little", signed=True)
        if self._open:
            self._open[-1][2].append(digest)

    def _text(self, text: str) -> None:
        if text and not text.isspace():
            # A number of many digits is no character; as a number it would be costly, or too long to read.
            text = entities.unescape(_LONG_NUMBER.sub(r"&#\1;", text) if "&#" in text else text)
            self._add("t", text)
            if self._open:
                self._open[-1][2].append(b"t" + " ".join(text.split()).encode("utf-8", "surrogatepass"))
        elif text:
            self._add("t", " ")

    def _parse(self, source: str) -> None:
        at = text = 0
        quoted, last = True, source.rfind(">")
        while (at := source.find("<", at)) >= 0:
            found = None
            if source.startswith("<!--", at):
                end = source.find("-->", at + 4)
                end = len(source) if end < 0 else end + 3
            elif at > last:
                break
            elif source[at + 1] in "!?":
                end = source.index(">", at) + 1
            else:
                found = _TAG.match(source, at) if quoted else None
                if found is None and (found := _PLAIN_TAG.match(source, at)) is not None:
                    quoted = False
                if found is None:
                    at += 1
                    continue
                end = found.end()
            self._text(source[text:at])
            at = text = end if found is None else self._tag(source, found)
        self._text(source[text:])
        self._close_from(0)

    def _tag(self, source: str, found: re.Match) -> int:
        """Take a tag in; returns where reading goes on."""
        tag, attrs, at = found[2].lower(), found[3], found.end()
        if found[1]:
            if self._depths.get(tag):
                self._close_from(self._depths[tag][-1])
            return at
        self._start(tag, attrs)
        if tag in _RAW and not attrs.rstrip().endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\s*+>", re.I).search(source, at)
            at = len(source) if close is None else close.end()
            self._pop()
        return at

    def attributes(self, i: int) -> dict[str, str]:
        return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(self.attrs[i])} if self.attrs[i].strip() else {}

    def _names(self, i: int) -> str:
        a = self.attributes(i)
        return f"{a.get('class', '')} {a.get('id', '')}"

    def dropped(self, i: int, inside: bool, by_name: bool = True) -> bool:
        """Whether the element at ``i`` is marked as no main text; ``inside``: it is in an article.

        Without ``by_name`` its class and id don't count.
        """
        tag = self.value[i]
        if tag in _DROPPED or (tag == "header" and not inside):
            return True
        if tag in ("html", "body", "main"):
            return False
        a = self.attributes(i)
        if not a:
            return False
        if (
            a.get("role", "").lower() in _ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true"
            or "display:none" in a.get("style", "").replace(" ", "").lower()
        ):
            return True
        if not by_name:
            return False
        names = self._names(i)
        if inside:
            return self._named_in_article(i, tag, names, a.get("class", ""))
        return _MARKED.search(names) is not None or _HEADING.search(names) is not None

    def _named_in_article(self, i: int, tag: str, names: str, classes: str) -> bool:
        if _MARKED.search(names) is None or re.fullmatch("h[1-6]", tag):
            return False
        marked = [n for n in (classes if tag in _PROSE else names).split() if _MARKED.search(n)]
        weak = [n.lower() for n in marked if _WEAK.fullmatch(n)]
        if len(weak) < len(marked):
            return True
        if not weak or tag in _PROSE:
            return False
        chars, linked, thread = (sums[self.end[i]] - sums[i] for sums in self._sums())
        if 2 * linked > chars:
            return True
        of_comments = any(n.startswith(("comment", "repl", "respond")) for n in weak)
        return of_comments and (thread > 0 or tag in ("section", "ol", "ul") and "comments" in weak)

    def _sums(self) -> tuple[list[int], list[int], list[int]]:
        """Before each event: characters of text, those in links, and elements that tell of a comment thread."""
        if self._running is None:
            chars, linked, thread = [0], [0], [0]
            depth = 0
            for kind, value, attrs in zip(self.kind, self.value, self.attrs):
                size = len("".join(value.split())) if kind == "t" else 0
                if kind != "t" and value == "a":
                    depth += 1 if kind == "<" else -1
                told = kind == "<" and (
                    value in ("form", "textarea", "time", "button") or bool(attrs) and any(
                        m[1].lower() == "class" and _THREAD.search(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(attrs)
                    )
                )
                chars.append(chars[-1] + size)
                linked.append(linked[-1] + (size if depth else 0))
                thread.append(thread[-1] + told)
            self._running = chars, linked, thread
        return self._running

    def roots(self) -> list[int]:
        """The elements whose text is the page's: outermost articles, main elements without one; none: all of it.

        Class words alone never leave out an article or what holds one or a main element; only articles in a
        container of reader comments stand back behind others.
        """
        if self._roots is None:
            self._roots = self._find_roots()
        return self._roots

    def _find_roots(self) -> list[int]:
        starts = [i for i, k in enumerate(self.kind) if k == "<"]
        main = {
            i for i in starts if self.value[i] == "main" or "main" in self.attrs[i] and self.attributes(i).get("role") == "main"
        }
        held = [i for i in starts if self.value[i] == "article" or i in main]
        articles, mains, comments, remarks = [], [], [], -1
        i = 0
        while i < len(self.kind):
            if self.kind[i] == "<":
                tag = self.value[i]
                at = bisect_left(held, i)
                holds = at < len(held) and held[at] < self.end[i]
                if i in main:
                    if not mains or i > self.end[mains[-1]]:
                        mains.append(i)
                elif tag not in ("html", "body") and self.dropped(i, False, not holds):
                    i = self.end[i]
                elif tag == "article":
                    (comments if i < remarks else articles).append(i)
                    i = self.end[i]
                elif holds and i > remarks and tag not in ("html", "body") and _COMMENTS.search(self._names(i)):
                    remarks = self.end[i]
            i += 1
        without = [m for m in mains if bisect_left(articles, m) == bisect_left(articles, self.end[m])]
        return sorted(articles + without) or comments

    def subtrees(self) -> set[int]:
        """Hashes of the elements that may be template, each once."""
        holders = [(r, self.end[r]) for r in self.roots()]
        return {
            self.digest[i] for i in range(len(self.kind))
            if self.kind[i] == "<" and self.value[i] in _BLOCK and self.end[i] > i + 1 and self._may_be_template(i, holders)
        }

    def _may_be_template(self, i: int, holders: list[tuple[int, int]]) -> bool:
        at = bisect_left(holders, (i,))
        if at < len(holders) and holders[at][1] <= self.end[i] or self.value[i] in ("html", "body", "head"):
            return False
        inside = at > 0 and i < holders[at - 1][1]
        return not (inside and self.value[i] in _PROSE)

    def blocks(self, template: frozenset[int] = frozenset()) -> list[str]:
        """The main text's blocks, without elements whose hash is in ``template``."""
        holders = [(r, self.end[r]) for r in self.roots()]
        found, words = [], []

        def flush():
            block = " ".join("".join(words).split())
            if block:
                found.append(block)
            words.clear()

        for a, b in holders or [(-1, len(self.kind))]:
            i = a + 1
            while i < b:
                kind, value = self.kind[i], self.value[i]
                if kind == "t":
                    words.append(value)
                elif kind == ">":
                    if value in _BLOCK:
                        flush()
                elif self.dropped(i, bool(holders)) or (
                    self.digest[i] in template and value in _BLOCK and self._may_be_template(i, holders)
                ):
                    if value in _BLOCK:
                        flush()
                    i = self.end[i]
                elif value in _BLOCK:
                    flush()
                elif value == "br":
                    words.append(" ")
                i += 1
            flush()
        return found


def host_of(url: Column) -> Column:
    """The url's host in lower case, empty if it has none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


_HASHED = pa.schema([("host", pa.string()), ("key", pa.string()), ("main", pa.int64()), ("hashes", pa.list_(pa.int64()))])


def _hash_rows(batches):
    for batch in batches:
        main, found = [], []
        for source in batch.column(2).to_pylist():
            page = Page(source)
            text = "\n\n".join(page.blocks()).encode("utf-8", "surrogatepass")
            main.append(int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True))
            found.append(list(page.subtrees()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(main, pa.int64()), pa.array(found, pa.list_(pa.int64()))], schema=_HASHED
        )


def page_templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, key, template)``: the hashes of the recurring subtrees of each distinct page (``key``: md5 of its html)."""
    html = pages["html"].cast("string")
    hashed = settle(
        pages.select(host_of(pages["url"]).alias("host"), F.md5(html).alias("key"), html.alias("html"))
        .filter("host != '' AND html != ''")
        .mapInArrow(_hash_rows, "host string, key string, main long, hashes array<long>")
        .dropDuplicates(["host", "key"]),
        "subtrees",
    )
    each = hashed.select("host", "key", "main", F.explode("hashes").alias("hash"))
    often = settle(
        each.select("host", "hash", "main").distinct().groupBy("host", "hash").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_pages).select("host", "hash"),
        "template",
    )
    return settle(each.join(often, ["host", "hash"]).groupBy("host", "key").agg(F.collect_set("hash").alias("template")), "templates")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """``(page_id, url, text, n_chars, n_blocks)``, one row per row of ``pages``."""
    html = pages["html"].cast("string")
    template = page_templates(pages, min_pages).select(F.col("host").alias("_host"), F.col("key").alias("_key"), "template")
    own = pages.select(
        pages["page_id"], pages["url"], html.alias("html"), host_of(pages["url"]).alias("_of"), F.md5(html).alias("_md5")
    )
    joined = own.join(template, (F.col("_of") == F.col("_host")) & (F.col("_md5") == F.col("_key")), "left").select(
        "page_id", "url", "html", "template"
    )

    def work(batches):
        for batch in batches:
            texts, sizes = [], []
            seen: dict[tuple, frozenset] = {}
            for source, hashes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                key = tuple(hashes or ())
                blocks = Page(source).blocks(seen.setdefault(key, frozenset(key))) if source else []
                texts.append("\n\n".join(blocks))
                sizes.append(len(blocks))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(sizes, pa.int64()),
            ], ["page_id", "url", "text", "n_chars", "n_blocks"])

    return joined.mapInArrow(work, T.StructType([
        pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()), T.StructField("n_blocks", T.LongType()),
    ]))


@query("op10_page_text")
def op10_page_text(spark, sf_dir):
    return extract(load(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
