"""Main text of web pages, with site templates found by counting element subtrees per host.

1. Every page is parsed into elements; each block element that may be boilerplate gets a hash of its
   subtree (tags and white-space-folded texts, not attributes).
2. Spark counts the hashes per host, once per page. A subtree that stands beside at least ``min_pages``
   different main texts is template, whatever share of the host's pages has it (``min_share`` may ask for more). Copies of
   a page have one rest, however many they are, so a story is no template of its host, whatever elements hold it.
3. Each page meets the hashes of its own that are template, and those subtrees are deleted. What
   elements say of themselves (navigation, header, footer, aside, form, advert, notice,
   comments ..., by tag or role) is deleted in any case. Outside articles a word of class or id deletes an element too, inside
   articles only if all words of the class or id say so (``share-buttons``, not ``share-price``), and nowhere if the
   element holds more than half of the page's article (or main, or body). The text is that of the
   outermost ``article`` elements if they hold half of the text of ``main`` (or the body), else of ``main``, else of
   the body. Headings and paragraphs inside an article are never template: copies of an article keep their text.

Blocks are separated by block elements; ``br`` is white space. Character references are decoded once,
white space in a block becomes one space, empty blocks go, the rest is joined by line breaks.

Null or empty pages give an empty text. Pages without a host count under one empty host. Repeated rows
are pages of their own. Equal counts need no order: each subtree is judged by itself. Very long and deeply nested pages
take time in proportion to their length. An empty table gives no rows. Only the three named columns are read, so other
columns may have any name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+"
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?:svg|math|template|noscript|iframe)(?=[\s/]){ATTRIBUTES}(?<=/)>"  # ends itself
    r"|<(?P<raw>script|style|iframe|textarea|title|xmp)(?=[\s/>]).*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<tree>template|noscript|svg|math)(?=[\s/>]).*?</(?P=tree)\s*>"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    rf"|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attributes>{ATTRIBUTES})>"
    r"|<(?P<broken>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)", re.DOTALL | re.IGNORECASE)
#: one attribute with its value, so that nothing in a value is taken for a name
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>]+)))?")
# element names with a meaning in the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol "
                  "optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr tbody thead caption figcaption".split())
NEVER = frozenset("html body main article head".split())
GONE = frozenset("head nav footer aside form button select dialog menu object canvas audio video map search".split())
ENDS_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
               "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS_ITEMS = frozenset("ul ol dl table select menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
NOISE = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager header masthead topbar footer bottombar "
    "sidebar aside widget related recommended recommendations teaser teasers cookie cookies consent gdpr notice "
    "notification alert popup modal overlay newsletter subscribe subscription signup login search share sharing "
    "social comment comments respond replies disqus discussion".split())


LAYOUT = frozenset(
    "area bar block body bottom box button buttons container count form foot group holder icon icons inline inner item items "
    "label left link links list module outer panel post primary right row secondary section site slot sticky tools top unit "
    "wrap wrapper zone".split())  # words that say where noise stands


class Element:
    __slots__ = ("tag", "gone", "scope", "in_article", "parts", "first_block", "mark", "article", "block")

    def __init__(self, tag: str, gone: bool, first_block: int, above: Element | None, place: int) -> None:
        self.tag, self.gone, self.first_block = tag, gone, first_block
        #: text and hashes of what is inside
        self.parts: list[bytes] = []
        self.in_article = tag == "article" or (above is not None and above.in_article)
        self.scope = 2 if self.in_article else 1 if tag == "main" or (above is not None and above.scope) else 0
        #: innermost mark around (0: none); mark around the outermost article (None: in no article)
        self.mark: int = above.mark if above is not None else 0
        self.article: int | None = above.article if above is not None else None
        #: place of the nearest block element in the stack, itself included
        self.block: int = place if above is None or tag in BLOCK else above.block


def attributes_of(attributes: str) -> dict[str, str]:
    """Values by lower-case name; the first of equal names counts."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    return found


def noisy(tag: str, own: dict[str, str], in_article: bool) -> bool:
    """Whether an element is no main text by its tag, role or hiding."""
    if tag in GONE or (tag == "header" and not in_article):
        return True
    if not own or tag in ("html", "body", "main"):
        return False
    return "hidden" in own or own.get("aria-hidden") == "true" or own.get("role") in ROLES


def named_noise(tag: str, own: dict[str, str], in_article: bool) -> bool:
    """Whether a class or id names noise; this holds unless most of the text is inside."""
    if not own or tag in ("html", "body", "main"):
        return False
    for name in (*own.get("class", "").split(), *own.get("id", "").split()):
        words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
        noise = [w in NOISE for w in words]
        if any(noise) and (not in_article or all(n or w in LAYOUT or w.isdigit() for n, w in zip(noise, words, strict=True))):
            return True
    return False


class Page:
    """Blocks of text with the scope they stand in, and hashes of subtrees."""

    def __init__(self, source: str | None, template: frozenset = frozenset()) -> None:
        self.template = template
        #: (hash, first block, block behind the last) of subtrees with text that is not gone
        self.subtrees: list[tuple[int, int, int]] = []
        #: (scope, text); scope 0 body, 1 main, 2 article
        self.blocks: list[tuple[int, str]] = []
        #: of each block the innermost mark around it and the one around its outermost article
        self.around: list[tuple[int, int | None]] = []
        self.outer_mark = [0]  # the mark around each mark; marks are numbered from 1 in page order
        self.stack = [Element("", False, 0, None, 0)]
        self.open_tags: dict[str, int] = {}
        self.text: list[str] = []
        self._read(source or "")

    def _read(self, source: str) -> None:
        at = 0
        for m in MARKUP.finditer(source):
            if m.start() > at:
                self.text.append(source[at:m.start()])
            at = m.end()
            if m["open"] or m["broken"]:
                self._open((m["open"] or m["broken"]).lower(), m["attributes"] or "")
            elif m["close"]:
                self._close(m["close"].lower())
            elif m["raw"] and m["raw"].lower() == "title":
                self._flush()
        self.text.append(source[at:])
        self._flush()
        while len(self.stack) > 1:
            self._pop()

    def _flush(self) -> None:
        if not self.text:
            return
        text = " ".join(html.unescape("".join(self.text)).split())
        self.text = []
        if text:
            top = self.stack[-1]
            top.parts.append(text.encode("utf-8", "surrogatepass"))
            if not top.gone:
                self.blocks.append((top.scope, text))
                self.around.append((top.mark, top.article))

    def _open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text.append(" ")
            return
        top = self.stack[-1]
        own = attributes_of(attributes) if attributes else {}
        if tag not in BLOCK:
            if tag in VOID:
                return
            if not top.gone and noisy(tag, own, False):
                self._flush()
                self._push(tag, True)
            elif not top.gone and named_noise(tag, own, top.in_article):
                self._flush()
                self._push(tag, False, True)
            elif top.gone or (top.mark and top.tag not in BLOCK):
                self._push(tag, top.gone)
            return
        self._flush()
        ends = ENDS_ITSELF.get(tag, ())
        while (k := self.stack[-1].block) and (self.stack[k].tag == "p" or self.stack[k].tag in ends):
            while len(self.stack) > k:  # an element that ends here without an end tag
                self._pop()
        if tag not in VOID:
            top = self.stack[-1]
            gone = top.gone or noisy(tag, own, top.in_article)
            self._push(tag, gone, not gone and named_noise(tag, own, top.in_article))

    def _push(self, tag: str, gone: bool, marked: bool = False) -> None:
        e = Element(tag, gone, len(self.blocks), self.stack[-1], len(self.stack))
        if marked:
            self.outer_mark.append(e.mark)
            e.mark = len(self.outer_mark) - 1
        if tag == "article" and e.article is None:
            e.article = e.mark
        self.stack.append(e)
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1

    def _close(self, tag: str) -> None:
        if tag in BLOCK:
            self._flush()
        if not self.open_tags.get(tag):
            return
        lowest = 0 if tag in BLOCK else self.stack[-1].block
        for k in range(len(self.stack) - 1, lowest, -1):
            if self.stack[k].tag == tag:
                self._flush()
                while len(self.stack) > k:
                    self._pop()
                return

    def _pop(self) -> None:
        self._flush()
        e = self.stack.pop()
        self.open_tags[e.tag] -= 1
        own = blake2b(e.tag.encode() + b"<" + b"|".join(e.parts) + b">", digest_size=8).digest()
        self.stack[-1].parts.append(own)
        if e.tag in BLOCK and e.tag not in NEVER and e.parts and not (e.in_article and e.tag in PROSE):
            value = int.from_bytes(own, "little", signed=True)
            if len(self.blocks) > e.first_block:
                self.subtrees.append((value, e.first_block, len(self.blocks)))
            if value in self.template:
                del self.blocks[e.first_block:], self.around[e.first_block:]

    def held(self) -> list[bool]:
        """Whether each block stays: marks hold unless more than half of the page's article is inside.

        The article is the text of the articles without a mark on or around them, else of all
        articles, else of main, else of the body.
        """
        if len(self.outer_mark) == 1:
            return [True] * len(self.blocks)
        pools = (lambda k: self.around[k][1] == 0, lambda k: self.around[k][1] is not None,
                 lambda k: self.blocks[k][0] == 1, lambda k: True)
        pool = next((p for p in ([k for k in range(len(self.blocks)) if test(k)] for test in pools) if p), [])
        inside = [0] * len(self.outer_mark)
        for k in pool:
            inside[self.around[k][0]] += len(self.blocks[k][1])
        half = sum(inside) / 2
        for mark in range(len(inside) - 1, 0, -1):  # marks inside come after those around them
            inside[self.outer_mark[mark]] += inside[mark] if self.outer_mark[mark] else 0
        stays = [True]
        for mark in range(1, len(inside)):
            stays.append(inside[mark] > half and stays[self.outer_mark[mark]])
        return [stays[mark] for mark, _ in self.around]

    def chosen(self, held: list[bool]) -> int:
        """The scope whose blocks are the main text: 2 articles, 1 main, 0 body."""
        sizes = [0, 0, 0]
        for (scope, text), stays in zip(self.blocks, held, strict=True):
            sizes[scope] += len(text) if stays else 0
        article, main, body = sizes[2], sizes[1] + sizes[2], sum(sizes)
        if article and 2 * article >= (main if sizes[1] else body):
            return 2
        return 1 if sizes[1] else 0

    def rests(self) -> dict[int, int]:
        """For each subtree a hash of the main text outside it (order of blocks aside)."""
        held = self.held()
        least = self.chosen(held)
        total = [0]
        for (scope, text), stays in zip(self.blocks, held, strict=True):
            own = blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest() if stays and scope >= least else b""
            total.append(total[-1] + int.from_bytes(own, "little"))
        out: dict[int, int] = {}
        for value, a, b in self.subtrees:
            out[value] = out.get(value, total[-1]) - (total[b] - total[a])
        return {value: (rest & (2**64 - 1)) - 2**63 for value, rest in out.items()}

    def main_text(self) -> str:
        held = self.held()
        least = self.chosen(held)
        return "\n".join(text for (scope, text), stays in zip(self.blocks, held, strict=True) if stays and scope >= least)


def page_subtrees(rows: DataFrame) -> DataFrame:
    """host, key and every distinct block subtree of each page with the hash of its other main text, written."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(Page(x.as_py()).rests().items()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), batch.column("key"), pa.array([[v for v, _ in f] for f in found], pa.list_(pa.int64())),
                 pa.array([[r for _, r in f] for f in found], pa.list_(pa.int64()))],
                ["host", "key", "subtrees", "rests"])

    kind = rows.schema["key"].dataType.simpleString()
    return materialise(rows.mapInArrow(
        find, f"host string, key {kind}, subtrees array<bigint>, rests array<bigint>"), "subtrees")


def template_subtrees(subtrees: DataFrame, min_pages: int, min_share: float) -> DataFrame:
    """host and subtree of what recurs beside different main texts on the pages of a host."""
    counts = (subtrees.select("host", F.explode(F.arrays_zip("subtrees", "rests")).alias("one"))
              .groupBy("host", F.col("one.subtrees").alias("subtree"), F.col("one.rests").alias("rest"))
              .agg(F.count(F.lit(1)).alias("n"))
              .groupBy("host", "subtree").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("different"))
              .where(F.col("different") >= min_pages))
    if min_share > 0:
        pages = subtrees.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
        counts = counts.join(pages, "host").where(F.col("n") >= min_share * F.col("pages"))
    return counts.select("host", "subtree")


def page_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
              min_pages: int = 3, min_share: float = 0.0, key: Column | None = None) -> DataFrame:
    """page_id, url and text of every page.

    ``key`` names each row again in a second scan (``parquet_row_key``); without it the
    columns are written once.
    """
    plain = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"),
                         F.col(html_column).alias("html"), *([] if key is None else [key.alias("key")]))
    if key is None:
        plain = materialise(plain.withColumn("key", F.monotonically_increasing_id()), "pages")
    host = F.lower(F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit("")))
    subtrees = page_subtrees(plain.select(host.alias("host"), "key", "html"))
    template = template_subtrees(subtrees, min_pages, min_share)
    own = (subtrees.select("host", "key", F.explode("subtrees").alias("subtree"))
           .join(template, ["host", "subtree"]).groupBy("key").agg(F.collect_set("subtree").alias("template")))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(source.as_py(), frozenset(found or ())).main_text() for source, found in
                     zip(batch.column("html"), batch.column("template").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"])

    kinds = {f.name: f.dataType.simpleString() for f in plain.schema}
    return plain.join(own, "key", "left").mapInArrow(
        extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
