"""Main text of web pages: parts that recur on a site and parts marked as furniture go.

Every page is read into elements; the subtree of each is hashed. Spark counts on how
many different pages of a host each subtree occurs, and those found on many are the
site's template: they are deleted wherever they occur. Hosts of few pages have no such
counts; there, as everywhere, go the elements that say what they are: by their tag, by
their role, or by a name of theirs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import blake2b
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.markup import BLOCKS, Element, Page, blocks
from tallybrook.llm.memory import small_slices

#: A subtree found on this many pages of a host, copies of a page counted once, is part of its template.
MANY = 4

#: Never text of an article.
FURNITURE = frozenset(
    "aside audio button canvas datalist dialog footer form head input menu nav object search select svg template video".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
#: Words of class names and ids that say the same.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay "
    "pager pagination paywall popup promo promoted promotion recommendations recommended related reply replies respond "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
#: A name that starts so tells of a page, not of the element: ``has-sidebar``, ``no-ads``.
ABOUT = frozenset("has is no non not with without".split())
#: Words at the end of a name that only place what it names.
HOLDING = frozenset("area bar block bottom box container content holder inner item left list module outer panel right section top wrap wrapper".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

#: Elements that authors write their text in. A site's template is told by what holds them.
_WRITTEN = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre figcaption caption td th tr tbody thead tfoot legend summary option optgroup hr".split())
_LISTS = frozenset("div ol p section table ul".split())
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.I)


def host_of(url: str | None) -> str:
    """The host of an address in small letters; empty for a NULL one or one without host."""
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _says(element: Element, names: frozenset[str]) -> bool:
    """Whether a class name or the id begins or ends with one of ``names``, what only places or holds it aside."""
    for name in element.names.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        while len(words) > 1 and (words[-1] in HOLDING or words[-1].isdigit()):
            words.pop()
        if words and words[0] not in ABOUT and (words[0] in names or words[-1] in names):
            return True
    return False


def _is_header(element: Element) -> bool:
    return element.tag == "header" or any(n.lower() in ("header", "page-header", "site-header", "topbar") for n in element.names.split())


class Article:
    """The pieces of a page's article, and the subtrees of it that may turn out to be template.

    With ``article`` or ``main`` elements (role ``main``, too) the text is theirs: of
    several that of the outermost articles, in ``main`` if there is one, without those
    that are mostly links. An article within another is a comment on it. A header is
    furniture outside an article and its heading inside. Pages that mark no article are
    taken whole, without lists of links.

    Subtrees offered as template are elements that hold others, and outside marked
    articles also single paragraphs and lines; what an author's texts have in common
    stays text. A subtree with half of the page's text or more is none.
    """

    def __init__(self, html: str):
        page = Page(html)
        elements = page.elements
        sizes = [0, *accumulate(len("".join(p.split())) for p in page.pieces)]
        size = lambda e: sizes[e.last] - sizes[e.first]
        linked = [0] * (len(page.pieces) + 1)
        for e in elements:
            if e.tag == "a":
                linked[e.first : e.last] = [1] * (e.last - e.first)
        links = [0, *accumulate(n * (b - a) for n, a, b in zip(linked, sizes, sizes[1:]))]
        link_share = lambda e: (links[e.last] - links[e.first]) / (size(e) or 1)

        told = [e.tag in FURNITURE or e.role in ROLES or self._is_named(e, size(e), sizes[-1]) for e in elements]
        gone = [False] * len(elements)
        for i, e in enumerate(elements[1:], 1):
            gone[i] = gone[e.parent] or (told[i] and e.tag not in ("html", "body", "main"))
        marked = [i for i, e in enumerate(elements) if e.tag in ("article", "main") or e.role in ("main", "article")]
        roots = self._roots(elements, [i for i in marked if not gone[i]], size, link_share)
        largest = max(marked, key=lambda i: size(elements[i]), default=0)
        if not roots and largest and 2 * size(elements[largest]) > sizes[-1]:
            # What is marked lies within something that is named like furniture.
            roots = [largest]
        whole = set(roots or [0])
        inside = [False] * len(elements)
        for i, e in enumerate(elements):
            inside[i] = i in whole or (i > 0 and inside[e.parent])
        text = sum(size(elements[i]) for i in whole)
        holders = {i for root in whole for i in self._above(elements, root)}

        kept = [False] * len(page.pieces)
        for i in whole:
            kept[elements[i].first : elements[i].last] = [True] * (elements[i].last - elements[i].first)
        offered: list[tuple[bytes, int, int]] = []
        for i, e in enumerate(elements):
            if i in holders or not size(e) or e.tag in ("html", "body"):
                continue
            comment = e.tag == "article" and bool(roots) and inside[i] and 2 * size(e) < text
            menu = not roots and e.tag in _LISTS and self._is_menu(elements, i, link_share)
            furniture = told[i] or comment or menu or (not roots and _is_header(e))
            if furniture and inside[i]:
                kept[e.first : e.last] = [False] * (e.last - e.first)
            holds = e.tag in BLOCKS and not (roots and e.tag in _WRITTEN)
            if furniture or (holds and 2 * size(e) < text):
                offered.append((e.digest, e.first, e.last))
        #: Hashes of all subtrees offered, for counting.
        self.subtrees = {d for d, _, _ in offered}
        self.pieces = [p for p, k in zip(page.pieces, kept) if k]
        place = [0, *accumulate(kept)]
        breaks, pending = [], False
        for new, k in zip(page.breaks, [*kept, True]):
            pending |= new
            if k:
                breaks.append(pending)
                pending = False
        self.breaks = breaks
        #: Those of them that hold pieces of the article: hash, first piece, piece after the last.
        self.offered = [(d, place[a], place[b]) for d, a, b in offered if place[a] < place[b]]

    @staticmethod
    def _is_named(e: Element, size: int, whole: int) -> bool:
        """Furniture by its names; what holds most of the page isn't, unless it names comments."""
        return bool(e.names) and (_says(e, NAMES) and 10 * size < 7 * whole or _says(e, COMMENTS))

    @staticmethod
    def _above(elements: list[Element], i: int) -> Iterator[int]:
        while i >= 0:
            yield i
            i = elements[i].parent

    def _roots(self, elements: list[Element], marked: list[int], size, link_share) -> list[int]:
        main = [i for i in marked if elements[i].tag == "main" or elements[i].role == "main"]
        articles = [i for i in marked if i not in main]
        if main:
            articles = [i for i in articles if any(m in main for m in self._above(elements, i))]
        known = set(articles)
        outermost = [i for i in articles if size(elements[i]) and not any(a in known for a in self._above(elements, elements[i].parent))]
        told = [i for i in outermost if link_share(elements[i]) < 0.5]
        return told or outermost or [i for i in main if size(elements[i])][:1]

    def _is_menu(self, elements: list[Element], i: int, link_share) -> bool:
        """A page that marks no article: an element with three links or more that are most of its text."""
        e = elements[i]
        if link_share(e) < 0.6:
            return False
        count = 0
        for other in elements[i + 1 :]:
            if other.first >= e.last or count > 2:
                break
            count += other.tag == "a" and other.last <= e.last
        return count > 2

    def text(self, template: set[bytes]) -> str:
        """The blocks of the article without the subtrees of the template."""
        return assemble(self.pieces, self.breaks, self.offered, template)


def assemble(pieces: list[str], breaks: list[bool], offered, template) -> str:
    kept = [True] * len(pieces)
    for digest, first, last in offered:
        if digest in template:
            kept[first:last] = [False] * (last - first)
    return "\n".join(blocks(pieces, breaks, kept))


def _page_key(host: str, html: str) -> bytes:
    return blake2b(f"{host}\0{html}".encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _pages(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    columns = [F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html")]
    return pages.select(*columns)


def _rows(batches: Iterator[pa.RecordBatch], html: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[str, str]]]]:
    """Slices of small texts, with host and html of their rows."""
    for batch in batches:
        for part in small_slices(batch, html):
            yield part, [(host_of(u), h or "") for u, h in zip(part.column(html - 1).to_pylist(), part.column(html).to_pylist())]


def _subtrees(pages: DataFrame) -> DataFrame:
    """page_key, host, subtree, content: what each page offers as template; content stands for the text of the page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _rows(batches, 1):
            out = []
            for host, html in rows:
                if host and html:
                    article = Article(html)
                    content = blake2b(article.text(set()).encode("utf-8", "surrogatepass"), digest_size=8).digest()
                    out += [(_page_key(host, html), host, d, content) for d in article.subtrees]
            columns = list(zip(*out)) or [()] * 4
            kinds = (pa.binary(), pa.string(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["page_key", "host", "subtree", "content"])

    return pages.select("url", "html").mapInArrow(run, "page_key binary, host string, subtree binary, content binary")


def extract_text(
    pages: DataFrame, folder: str, many: int = MANY, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """page_id, url, text, n_chars, n_template: the main text of each page, one row for each of ``pages``.

    Subtrees found on at least ``many`` pages of a host whose articles differ are its
    template and go; ``n_template`` is how many of the page's subtrees those are.
    Furniture goes, too (see :class:`Article`). References are decoded, white space
    within a block becomes one blank, blocks are joined in their order by a line feed.

    Defined cases: a NULL or empty page has an empty text; so has one without any text
    in its article. A NULL address, or one without host, has no template. Rows that
    repeat are extracted each and count as one page. Unclosed comments, scripts and
    tags reach to the end of the page. Other columns, whatever their name, play no
    part. ``folder`` is shared by all workers.
    """
    spark = pages.sparkSession
    rows = _pages(pages, page_id, url, html)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    # Tables of their own: where both sides of a join are read anew, the rows of a hot host are split over tasks.
    found = written(_subtrees(rows), "subtrees")
    counts = found.groupBy("host", "subtree").agg(F.count_distinct("content").alias("n"))
    template = written(counts.where(F.col("n") >= many).select("host", "subtree"), "template")
    mine = found.select("page_key", "host", "subtree").join(template, ["host", "subtree"]).select("page_key", "subtree").distinct()
    deleted = written(mine.groupBy("page_key").agg(F.collect_list("subtree").alias("template")), "deleted")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=6)
        for part, rows in _rows(batches, 2):
            keys, packed = [], []
            for host, html in rows:
                article = Article(html)
                keys.append(_page_key(host, html))
                parts = [[d.hex(), a, b] for d, a, b in article.offered]
                packed.append(pack.compress(json.dumps([article.pieces, article.breaks, parts]).encode()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())], ["page_id", "url", "page_key", "packed"]
            )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for part in small_slices(batch, 2):
                texts, counts = [], []
                for packed, gone in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    pieces, breaks, offered = json.loads(unpack.decompress(packed))
                    texts.append(assemble(pieces, breaks, offered, {d.hex() for d in gone or ()}))
                    counts.append(len(gone or ()))
                lengths = pa.array(map(len, texts), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), lengths, pa.array(counts, pa.int32())],
                    ["page_id", "url", "text", "n_chars", "n_template"],
                )

    kind = rows.schema["page_id"].dataType.simpleString()
    parsed = rows.mapInArrow(read, f"page_id {kind}, url string, page_key binary, packed binary")
    joined = parsed.join(deleted, "page_key", "left").select("page_id", "url", "packed", "template")
    return joined.mapInArrow(finish, f"page_id {kind}, url string, text string, n_chars long, n_template int")
