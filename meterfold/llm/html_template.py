"""Main text of web pages, without what a site repeats on its pages."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterfold import scratch
from meterfold.llm.url_lists import host_of

#: A subtree on so many different articles of a host belongs to its template.
MANY_PAGES = 5

# Element names of the HTML standard, and words that pages use in class, id and
# role for what is not their article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = frozenset(
    "head title script style noscript template iframe object svg canvas audio video button input select option "
    "textarea".split()
)
PARTS = frozenset("nav footer aside menu".split())
WRAPS = frozenset("form label fieldset dialog".split())
BLOCKS = frozenset(
    "html body address article aside blockquote caption center dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul".split()
)
CONTAINERS = frozenset("div section ul ol dl table details figure header center".split())
#: Elements whose subtrees are counted.
COUNTED = CONTAINERS | PARTS | {"form"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
    "menu breadcrumb breadcrumbs header masthead footer sidebar cookie cookies consent gdpr notice alert popup modal "
    "overlay newsletter subscribe subscription signup login comment comments reply replies disqus share sharing social "
    "related recommended toolbar pagination pager search form widget skip".split()
)
COMMENT_HINTS = frozenset("comment comments reply replies".split())
#: What announces adverts, and other texts than the page's own.
AD_HINTS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion".split())
OTHER_HINTS = COMMENT_HINTS | frozenset("disqus related recommended".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())

_SPLIT = re.compile(r"[^a-z]+")
_CUT_TAG = re.compile(r"<(?:[A-Za-z/!?][^<>]*)?\Z")
_SPACE = re.compile(r"\s+")


def _name_kind(tag: str, region: str, named: dict[str, str]) -> tuple[str, bool]:
    """What the names of an element say: what it surely is if not article, and whether they hint at that.

    A class token or id counts if it has hint words only. One that has others as well
    (``has-sidebar``, ``related-work``) is a hint. Headings are never judged by a name,
    paragraphs not by their id.
    """
    if tag in ("html", "body", "main") or tag in HEADINGS:
        return "", False
    tokens = named.get("class", "").split() + ([] if tag == "p" else [named.get("id", "")])
    words = [[w for w in _SPLIT.split(t) if w] for t in tokens]
    if tag == "article":
        return ("other" if any(w and (set(w) <= COMMENT_HINTS or w[0] in ("comment", "reply")) for w in words) else ""), False
    known = HINTS - {"header", "masthead"} if region else HINTS
    sure = {x for w in words if w and set(w) <= known for x in w}
    kind = "part" if sure & AD_HINTS else "other" if sure & OTHER_HINTS else "name" if sure else ""
    return kind or ("name" if named.get("role") in ROLES else ""), any(known & set(w) for w in words)


def _name(text: str) -> int:
    name = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))
    return name - (1 << 64) if name >> 63 else name


@dataclass(slots=True)
class _Open:
    """An open element; counts are those of the reader when it opened."""

    tag: str
    silent: bool  #: has no text
    region: str
    first: int  #: event
    number: int
    marks: tuple[int, ...]  #: numbers of the elements from the page to here that may be no article
    link: bool
    title: bool
    unsure: str = ""  #: what is decided when it closes
    chars: int = 0
    linked: int = 0
    mains: int = 0
    titles: int = 0
    paragraphs: int = 0


@dataclass(slots=True)
class _Text:
    text: str
    region: str
    around: tuple[int, ...]  #: numbers of containers
    marks: tuple[int, ...]
    title: bool


class _Reader(HTMLParser):
    """Blocks of text with their region, the subtrees around them that may be template, and what marks them as no article."""

    def __init__(self, names: bool = True):
        super().__init__(convert_charrefs=True)
        self.names = names
        self.open: list[_Open] = []
        self.events: list[str] = []
        self.blocks: list[_Text] = []
        self.hashes: dict[int, list[int]] = {}
        #: Elements that are no article: "part" of the site, "other" texts, form ("wrap"), or by "name".
        self.dropped: dict[int, str] = {}
        self.inline: set[int] = set()
        #: Marks around each region.
        self.outer: dict[str, set[int]] = {}
        #: The element that each article is in.
        self.parents: dict[str, int] = {}
        self.text: list[tuple[str, tuple[int, ...]]] = []
        self.regions = self.numbers = self.chars = self.linked = self.mains = self.titles = self.paragraphs = 0

    def flush(self) -> None:
        pieces: dict[tuple[int, ...], list[str]] = {}
        for piece, marks in self.text:
            pieces.setdefault(marks, []).append(piece)
        self.text.clear()
        for marks, own in pieces.items():
            text = _SPACE.sub(" ", "".join(own)).strip()
            if text:
                if not self.inline.intersection(marks):
                    self.events.append(text)
                around = tuple(e.number for e in self.open if e.tag in COUNTED)
                top = self.open[-1] if self.open else None
                self.blocks.append(_Text(text, top.region if top else "", around, marks, bool(top and top.title)))

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append((" ", self.open[-1].marks if self.open else ()))
            return
        if tag in BLOCKS:
            self.flush()
            if any(e.tag == "p" for e in self.open):
                self._close("p")
            if tag in SIBLINGS:
                for k in range(len(self.open) - 1, -1, -1):
                    if self.open[k].tag in SIBLINGS[tag]:
                        self._pop_to(k)
                        break
                    if self.open[k].tag in ("ul", "ol", "dl", "table"):
                        break
        if tag in VOID:
            return
        up = self.open[-1] if self.open else None
        silent, region, marks = (up.silent, up.region, up.marks) if up else (False, "", ())
        silent = silent or tag in NO_TEXT
        named = {k: (v or "").lower() for k, v in attrs if k in ("class", "id", "role", "hidden")}
        self.numbers += 1
        kind = unsure = ""
        if not silent:
            kind, hint = _name_kind(tag, region, named) if self.names else ("", False)
            if not self.names:
                pass
            elif tag in PARTS or "hidden" in named:
                kind = "part"
            elif not kind and tag == "header" and not region:
                kind = "name"
            elif not kind and tag in WRAPS:
                unsure = "wrap"
            elif not kind and hint and tag in BLOCKS and tag != "p":
                unsure = "name"
            if kind or unsure:
                marks = (*marks, self.numbers)
            if kind:
                self.dropped[self.numbers] = kind
            if (kind or unsure) and tag not in BLOCKS:
                self.inline.add(self.numbers)
            if tag == "article" and not region.startswith("article"):
                self.regions += 1
                region = f"article {self.regions}"
                self.parents[region] = up.number if up else 0
                self.outer[region] = set(marks)
            elif tag == "main" and not region:
                region = "main"
                self.outer[region] = self.outer.get(region, set(marks)) & set(marks)
        self.open.append(
            _Open(
                tag, silent, region, len(self.events), self.numbers, marks, tag == "a" or bool(up and up.link),
                tag == "h1" or bool(up and up.title), unsure, self.chars, self.linked, self.mains, self.titles,
                self.paragraphs,
            )
        )
        if not silent:
            self.mains += tag in ("article", "main")
            self.titles += tag == "h1"
            self.paragraphs += tag == "p"
            self.events.append(f"\0{tag} {named.get('class', '')}")

    def _shut(self, e: _Open) -> None:
        """Settle what a closed element is. What is no article leaves nothing in the subtrees around it."""
        if e.unsure and self.mains == e.mains:
            chars, linked = self.chars - e.chars, self.linked - e.linked
            if e.unsure == "wrap" and self.titles == e.titles or e.unsure == "name" and 2 * linked > chars:
                self.dropped[e.number] = e.unsure
        if e.tag in COUNTED and not e.silent:
            self.hashes[e.number] = self._names_of(e)
        if e.number in self.dropped:
            del self.events[e.first :]

    def _names_of(self, e: _Open) -> list[int]:
        """The name of a subtree, and that of its kinds of elements where it is a list of links above the text.

        The wording of menus differs from page to page, their make does not. Lists of links in an
        article, or below the first paragraph, may be its references and have the first name only.
        """
        events = self.events[e.first :]
        found = [_name("\x1f".join(events))]
        chars, linked = self.chars - e.chars, self.linked - e.linked
        if 2 * linked > chars and not self.paragraphs and not e.region and self.mains == e.mains and self.titles == e.titles:
            found.append(_name("\x1e".join(dict.fromkeys(x for x in events if x[:1] == "\0"))))
        return found

    def _pop_to(self, k: int) -> None:
        """Close the open elements from the k-th on."""
        self.flush()
        while len(self.open) > k:
            self._shut(self.open.pop())

    def _close(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].tag == tag:
                self._pop_to(k)
                return

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        if tag not in VOID:
            if tag not in BLOCKS and self.open:
                # An inline end tag never closes the block it is in.
                for k in range(len(self.open) - 1, -1, -1):
                    if self.open[k].tag == tag:
                        while len(self.open) > k:
                            self._shut(self.open.pop())
                        return
                    if self.open[k].tag in BLOCKS:
                        return
            else:
                self._close(tag)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        top = self.open[-1] if self.open else None
        if not (top and top.silent):
            self.text.append((data, top.marks if top else ()))
            size = len(data.strip())
            self.chars += size
            self.linked += size if top and top.link else 0

    def finish(self) -> None:
        self.close()
        self._pop_to(0)


def _chosen(blocks: list[_Text]) -> str | None:
    """The article with the most text, else ``main``, else nothing for the page."""
    sizes: dict[str, int] = {}
    for b in blocks:
        sizes[b.region] = sizes.get(b.region, 0) + len(b.text)
    articles = [r for r in sizes if r.startswith("article")]
    return max(articles, key=lambda r: (sizes[r], -int(r.split()[1]))) if articles else "main" if "main" in sizes else None


@dataclass(slots=True)
class Page:
    """All blocks of a page, and what their names say of them."""

    blocks: list[_Text]
    #: For each block the names of the subtrees that it is a part of.
    around: list[list[int]]
    dropped: dict[int, str]
    outer: dict[str, list[int]]
    parents: dict[str, int]

    def packed(self) -> bytes:
        whole = [
            [b.text for b in self.blocks], [b.region for b in self.blocks], [b.marks for b in self.blocks],
            [b.title for b in self.blocks], self.around, list(self.dropped.items()), self.outer, self.parents,
        ]
        return zstandard.ZstdCompressor(level=3).compress(json.dumps(whole).encode())

    @staticmethod
    def unpacked(data: bytes) -> Page:
        texts, regions, marks, titles, around, dropped, outer, parents = json.loads(zstandard.ZstdDecompressor().decompress(data))
        blocks = [_Text(t, r, (), tuple(m), title) for t, r, m, title in zip(texts, regions, marks, titles)]
        return Page(blocks, around, dict(dropped), outer, parents)

    def article(self, template: frozenset[int] = frozenset()) -> list[int]:
        """Places of the blocks of the article, without those in subtrees of the template.

        The article is the ``article`` element with the most text and those next to it in the same
        element, else ``main``, else the page; a title of ``main`` goes with articles that
        have none. Elements that are no text, or that their name, class, id or role marks
        as a part of the site, are left out, unless they are around an article that has
        more text than all articles outside them, or nothing else is left.
        """
        own = [i for i, names in enumerate(self.around) if template.isdisjoint(names)]
        places = {id(self.blocks[i]): i for i in own}
        every = [self.blocks[i] for i in own]
        dropped = self.dropped

        def left(but: set[int]) -> list[_Text]:
            return [b for b in every if all(n not in dropped or n in but for n in b.marks)]

        def of_kinds(*kinds: str) -> set[int]:
            return {n for n, kind in dropped.items() if kind in kinds}

        blocks = left(set())
        chosen = _chosen(blocks)
        regional, found = sum(len(b.text) for b in blocks if b.region), []
        for region, marks in self.outer.items():
            around = {n for n in marks if n in dropped}
            if around and all(dropped[n] in ("name", "wrap") for n in around):
                inside = left(around)
                size = sum(len(b.text) for b in inside if b.region == region)
                if size > regional:
                    found.append((region != "main", size, region, inside))
        if found:
            _, _, chosen, blocks = max(found, key=lambda f: f[:2])
        if chosen is None:
            whole = left(of_kinds("wrap"))
            if sum(len(b.text) for b in whole) > 2 * sum(len(b.text) for b in blocks):
                blocks, chosen = whole, _chosen(whole)
        for kinds in (("wrap", "name"), ("wrap", "name", "other")):
            if not blocks:
                blocks = left(of_kinds(*kinds))
                chosen = _chosen(blocks)
        parent = self.parents.get(chosen, -1)
        regions = {chosen, *(r for r, p in self.parents.items() if p == parent)}
        untitled = chosen not in (None, "main") and not any(b.title for b in blocks if b.region in regions)
        return [
            places[id(b)]
            for b in blocks
            if chosen is None or b.region in regions or untitled and b.title and b.region == "main"
        ]


    def settled(self) -> bool:
        """Whether the article is the same whatever the template is.

        So it is if there is an ``article`` or ``main`` and nothing in such elements is part of a
        subtree that is counted: the choice looks at nothing else then.
        """
        regional = [i for i, b in enumerate(self.blocks) if b.region]
        chosen = self.article()
        return not any(self.around[i] for i in regional) and bool(chosen) and all(self.blocks[i].region for i in chosen)


def opened(html: str | None, names: bool = True) -> Page:
    """A page read; without ``names`` no element is judged by what it is called."""
    reader = _Reader(names)
    reader.feed(_CUT_TAG.sub("", html or ""))
    reader.finish()
    around = []
    for b in reader.blocks:
        # What is no article is not in the names of the subtrees around it.
        inner = max((n for n in b.marks if n in reader.dropped), default=0)
        around.append([h for n in b.around if n >= inner for h in reader.hashes.get(n, ())])
    return Page(reader.blocks, around, reader.dropped, {r: sorted(m) for r, m in reader.outer.items()}, reader.parents)


def read_page(html: str | None) -> list[tuple[str, list[int]]]:
    """Blocks of the article in page order, each with the names of the subtrees around it."""
    page = opened(html)
    return [(page.blocks[i].text, page.around[i]) for i in page.article()]


READ = "row_key bigint, page_id bigint, url string, host string, article bigint, text string, page binary, subtrees array<bigint>"
TEXTS = "page_id bigint, url string, text string, n_chars bigint"


def _read(names: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, packed, articles, subtrees = [], [], [], []
            for html in batch.column("html"):
                page = opened(html.as_py(), names)
                chosen = page.article()
                plain = [page.blocks[i].text for i in chosen if not page.around[i]] or [page.blocks[i].text for i in chosen]
                articles.append(_name("\n".join(plain)))
                settled = page.settled()
                texts.append("\n\n".join(page.blocks[i].text for i in chosen) if settled else None)
                packed.append(None if settled else page.packed())
                subtrees.append(sorted({h for hs in page.around for h in hs}))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in ("row_key", "page_id", "url", "host")), pa.array(articles, pa.int64()),
                    pa.array(texts, pa.string()), pa.array(packed, pa.binary()), pa.array(subtrees, pa.list_(pa.int64())),
                ],
                names=["row_key", "page_id", "url", "host", "article", "text", "page", "subtrees"],
            )

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for data, template in zip(batch.column("page"), batch.column("template")):
            page = Page.unpacked(data.as_py())
            texts.append("\n\n".join(page.blocks[i].text for i in page.article(frozenset(template.as_py() or ()))))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame, many: int = MANY_PAGES, names: bool = True) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` for every row of ``pages``.

    ``pages`` has ``page_id``, ``url`` and ``html``; other columns are not read. Null and empty pages have
    an empty text; pages without a host are counted as one host. Repeated rows come
    back each.

    All subtrees of a page are hashed as they close, menus and footers too, and lists of links above
    the text by their make as well. Spark counts on how many different articles of a host
    each one is, and those on ``many`` are deleted from every page of it; copies of one
    article count once. Pages whose article no deletion can change count as well, but need not be
    looked up (``Page.settled``). Single paragraphs and headings of an article are no template
    however often they recur: shared passages stay. The article is chosen from what is
    left. Advertisements and footers that differ from page to page recur in no way; with
    ``names`` what the markup calls so goes in any case.
    """
    rows = pages.select(
        F.xxhash64(F.col("page_id"), F.col("url"), F.col("html")).alias("row_key"),
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(host_of(F.col("url").cast("string")), F.lit("")).alias("host"), F.col("html").cast("string").alias("html"),
    )
    read = scratch.stored(rows.mapInArrow(_read(names), READ), "pages")
    settled = F.col("text").isNotNull()
    subtrees = read.select("row_key", "host", "article", settled.alias("settled"), F.explode("subtrees").alias("subtree"))
    template = (
        subtrees.select("host", "subtree", "article").distinct()
        .groupBy("host", "subtree").agg(F.count("*").alias("articles")).where(F.col("articles") >= many)
    )
    deleted = (
        subtrees.where("not settled").join(template, ["host", "subtree"])
        .groupBy("row_key").agg(F.collect_set("subtree").alias("template"))
    )
    open_pages = read.where(~settled).select("row_key", "page_id", "url", "page").join(deleted, "row_key", "left")
    found = open_pages.select("page_id", "url", "page", "template").mapInArrow(_texts, TEXTS)
    return read.where(settled).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")).union(found)
