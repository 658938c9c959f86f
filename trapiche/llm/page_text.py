"""Main text of web pages: markup to lines, nearest-URL page differencing, article lines."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from html.parser import HTMLParser
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trapiche.llm.common import named
from trapiche.llm.key_filter import key_filter
from trapiche.llm.url_rules import url_parts
from trapiche.sinks.writers import store

# Different pages that one task judges at a time, in order of host and path; no result depends on it.
BLOCK = 256
# Pages on either side, in that order, among which a page's neighbours are sought.
WINDOW = 16
# Different pages a page is compared with; inside an article element all of them must share a
# line, and there must be so many at least.
PAGE_NEIGHBOURS = 2
ARTICLE_NEIGHBOURS = 6
LEAST_ARTICLE_NEIGHBOURS = 3

# Elements of HTML by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(
    "head script style template noscript iframe object svg math canvas audio video map "
    "button select option textarea input label fieldset datalist dialog".split()
)
ASIDE = frozenset("nav footer aside menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "p pre search section summary table tbody td tfoot th thead tr ul".split()
)
MAIN = frozenset(("article", "main"))
# What may stand in a head; anything else ends a head that is still open.
HEAD_CONTENT = frozenset(
    "base basefont bgsound link meta noframes noscript script style template title".split()
)
# Elements that a new block element closes if it is still open.
CLOSED_BY_BLOCK = frozenset(("p",))
SELF_CLOSING = {
    "li": frozenset(("li",)),
    "dd": frozenset(("dd", "dt")),
    "dt": frozenset(("dd", "dt")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
}
# Words in class, id or role that mark what is not the article.
BOILERPLATE = frozenset(
    "advert adverts advertisement alert breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus footer gdpr login masthead modal newsletter notice notices "
    "notification pager pagination popup promo promoted promotion related replies reply respond share "
    "sharing signup social sponsor sponsored subscribe subscription".split()
)
# The same, but layouts around an article are named by these as well.
LAYOUT = frozenset(
    "ad ads banner header menu nav navbar navigation sidebar sidebars toolbar widget widgets".split()
)

# Words that name an article when they stand alone in a class list, whatever else it says, and
# those that name what readers wrote, which no other word outweighs.
CONTENT = frozenset("article content entry main post story".split())
REMARKS = frozenset("comment comments disqus replies reply respond".split())
# Where a line stands.
ASIDE_LINE, PAGE_LINE, ARTICLE_LINE, FORM_LINE, DOUBTFUL_LINE = range(5)

# Inline elements left open at the end of a paragraph end with it.
INLINE_KEPT_OPEN = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike "
    "strong sub sup time tt u var".split()
)

_SEPARATORS = str.maketrans("-_:/.", "     ")


class _Lines(HTMLParser):
    """Blocks of visible text, each with where it stands.

    Text of a form counts only if there is no other. An article that class words alone call
    something else, and such parts of one, are doubtful.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self.open: list[tuple[str, str]] = []
        self.text: list[str] = []
        self.begun: int | None = None

    def _place(self) -> int | None:
        """None for hidden text."""
        kinds = [kind for _, kind in self.open if kind]
        if "hidden" in kinds:
            return None
        if "aside" in kinds:
            return ASIDE_LINE
        if "said" in kinds:
            return DOUBTFUL_LINE if "main" in kinds else ASIDE_LINE
        inner = kinds[-1] if kinds else ""
        return {"main": ARTICLE_LINE, "form": FORM_LINE, "layout": ASIDE_LINE, "": PAGE_LINE}[inner]

    def end_block(self) -> None:
        line = " ".join("".join(self.text).split())
        self.text.clear()
        place = self._place()
        if line:
            # Text that a hidden element was opened behind stands where it began.
            self.lines.append((line, self.begun if place is None else place))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open and self.open[-1][0] == "head" and tag not in HEAD_CONTENT:
            self.end_block()
            self.open.pop()
        if tag == "br":
            self.text.append(" ")
            return
        if tag in BLOCKS:
            self.end_block()
            closing = SELF_CLOSING.get(tag, frozenset()) | CLOSED_BY_BLOCK
            while self.open and self.open[-1][0] in closing | INLINE_KEPT_OPEN:
                if not any(name in closing for name, _ in self.open):
                    break
                self.open.pop()
        if tag in VOID:
            return
        self.open.append((tag, self._kind(tag, attrs)))

    def _kind(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        if tag in HIDDEN:
            return "hidden"
        if tag in ASIDE or (tag == "header" and not any(k == "main" for _, k in self.open)):
            return "aside"
        if tag not in ("html", "body"):
            values = dict(attrs)
            if "hidden" in values or (values.get("aria-hidden") or "").lower() == "true":
                return "hidden"
            listed = " ".join(values.get(a) or "" for a in ("class", "id", "role")).lower()
            alone = listed.split()
            remarks = not REMARKS.isdisjoint(alone)
            if remarks or (tag not in MAIN and CONTENT.isdisjoint(alone)):
                said = listed.translate(_SEPARATORS).split()
                if not REMARKS.isdisjoint(said):
                    return "aside"
                if not BOILERPLATE.isdisjoint(said):
                    return "said"
                if not LAYOUT.isdisjoint(said):
                    return "layout"
        if tag == "form":
            return "form"
        return "main" if tag in MAIN else ""

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_block()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                if any(name in BLOCKS or name in HIDDEN for name, _ in self.open[at:]):
                    self.end_block()
                del self.open[at:]
                return
            # An inline end tag does not close the block around it.
            if tag not in BLOCKS and tag not in HIDDEN and self.open[at][0] in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        place = self._place()
        if place is not None:
            self.text.append(data)
            self.begun = place


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """Visible blocks of a page in order, white space inside as one space."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser.end_block()
    return parser.lines


def shared_lines(own: Sequence, other: Sequence) -> list[int]:
    """Positions in `own` of a longest common subsequence with `other`.

    Rows of the table are bit vectors, one bit per line of `own`, zero where the length grows.
    """
    where: dict = {}
    for i, line in enumerate(own):
        where[line] = where.get(line, 0) | 1 << i
    every = (1 << len(own)) - 1
    rows = [every]
    for line in other:
        match = where.get(line, 0) & rows[-1]
        rows.append(((rows[-1] + match) | (rows[-1] - match)) & every)
    found, i, j = [], len(own), len(other)
    while i and j:
        bit = 1 << (i - 1)
        if rows[j] & bit:
            i -= 1
        elif not rows[j - 1] & bit:
            j -= 1
        else:
            found.append(i - 1)
            i, j = i - 1, j - 1
    return found[::-1]


def body_places(places: Sequence[int]) -> tuple[list[int], bool]:
    """Positions of the lines that may be the text, and whether an article element marks them.

    Those of the article element; without them what was doubtful in it, then all that is not
    marked as something else, then what stands in forms.
    """
    for wanted in (ARTICLE_LINE, DOUBTFUL_LINE, PAGE_LINE, FORM_LINE):
        found = [i for i, place in enumerate(places) if place == wanted]
        if found:
            return found, wanted in (ARTICLE_LINE, DOUBTFUL_LINE)
    return [], False


class Page(NamedTuple):
    """What differencing knows of a page: its visible lines, as hashes, and its body."""

    content: bytes
    marks: list[int]
    body: list[int]
    marked: bool


def template_lines(page: Page, near: Iterable[Page]) -> set[int]:
    """Body lines that belong to the template, by their number in the body.

    `near` goes from the nearest outwards; pages with equal content are one page, and the page's
    own content is skipped. A neighbour that is a copy of the article shows no template and the
    next one takes its place. Outside article elements a line goes if one of the nearest two
    different pages shares it; a copy is a page with more than half of those lines that fewer
    than half of the pages around hold (with a single page around: half of all lines). Inside an
    article element, where neighbours may well quote the same line, all of the six nearest must
    share it, three at least; a copy is a page with more than half of its lines.
    """
    others = list({other.content: other for other in near if other.content != page.content}.values())
    own = [page.marks[i] for i in page.body]
    known = set(own)
    if page.marked or len(others) < 2:
        judged, half = set(range(len(own))), len(others) >= 2
    else:
        held = Counter(mark for other in others for mark in known.intersection(other.marks))
        judged, half = {i for i, mark in enumerate(own) if 2 * held[mark] < len(others)}, True
    wanted = ARTICLE_NEIGHBOURS if page.marked else PAGE_NEIGHBOURS
    found: list[set[int]] = []
    for other in others:
        theirs = [other.marks[i] for i in other.body]
        lines = set() if known.isdisjoint(theirs) else set(shared_lines(own, theirs))
        same = 2 * len(lines & judged)
        if judged and (same > len(judged) or (not half and same == len(judged))):
            continue
        found.append(lines)
        if len(found) == wanted:
            break
    if not found or not judged or (page.marked and len(found) < LEAST_ARTICLE_NEIGHBOURS):
        return set()
    return set.intersection(*found) if page.marked else set.union(*found)


def around(pages: Sequence[Page | None], at: int) -> Iterator[Page]:
    """The pages within the window around a place, from the nearest outwards."""
    for away in range(1, WINDOW + 1):
        for i in (at - away, at + away):
            if 0 <= i < len(pages) and pages[i] is not None:
                yield pages[i]


def _page(html: str | None) -> dict:
    found = page_lines(html)
    body, marked = body_places([place for _, place in found])
    marks = [xxhash.xxh64_intdigest(line) - (1 << 63) for line, _ in found]
    content = xxhash.xxh128_digest(repr((marks, body, marked)))
    return {
        "lines": [found[i][0] for i in body],
        "content": content,
        "marks": marks,
        "body": body,
        "marked": marked,
    }


_PAGE_KINDS = {
    "lines": pa.list_(pa.string()),
    "content": pa.binary(),
    "marks": pa.list_(pa.int64()),
    "body": pa.list_(pa.int32()),
    "marked": pa.bool_(),
}
_PAGE_COLUMNS = (
    "lines array<string>, content binary, marks array<long>, body array<int>, marked boolean"
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = ["id", "url", "host", "path"]
    for batch in batches:
        found = [_page(html.as_py()) for html in batch["html"]]
        columns = [pa.array([f[c] for f in found], kind) for c, kind in _PAGE_KINDS.items()]
        yield pa.RecordBatch.from_arrays(
            [*(batch[c] for c in kept), *columns], [*kept, *_PAGE_KINDS]
        )


def _judge(block: pa.Table) -> pa.Table:
    """Template lines of the block's own pages; the pages beside it are neighbours only."""
    block = block.sort_by("position")
    names = ("host", "path", "content", "marks", "body", "marked", "own")
    rows = list(zip(*(block[c].to_pylist() for c in names)))
    pages = [Page(*row[2:6]) for row in rows]
    found = []
    for at, (host, path, content, *_, own) in enumerate(rows):
        if own:
            low = max(0, at - WINDOW)
            same = [
                page if row[0] == host else None
                for page, row in zip(pages[low : at + WINDOW + 1], rows[low : at + WINDOW + 1])
            ]
            gone = template_lines(pages[at], around(same, at - low))
            if gone:
                found.append((host, path, content, sorted(gone)))
    columns = list(zip(*found)) or [()] * 4
    kinds = [pa.string(), pa.string(), pa.binary(), pa.list_(pa.int32())]
    return pa.Table.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)],
        names=["host", "path", "content", "gone"],
    )


def _numbered(contents: DataFrame) -> DataFrame:
    """The rows with `position`, their number in the order of host, path and content.

    Spark sorts ranges of them; the driver sees one count per range.
    """
    spark, keys = contents.sparkSession, ["host", "path", "content"]
    ranged = contents.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranged = store(ranged.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = ranged.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts = [0, *accumulate(r["count"] for r in sizes)]
    offsets = spark.createDataFrame(
        [(r["part"], start) for r, start in zip(sizes, starts)], "part long, start long"
    )
    place = F.col("at").bitwiseAND((1 << 33) - 1)
    return (
        ranged.withColumn("part", part)
        .join(offsets, "part")
        .withColumn("position", F.col("start") + place)
        .drop("part", "start", "at")
    )


def extract_main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: id, url, `text` (blocks in page order by two line feeds), `n_chars` and
    `n_template` (lines of the body that went because neighbours share them).

    Pages are sorted by path within their host and compared with the nearest different pages,
    whichever side they lie on, up to WINDOW of them on either side. Null and empty pages have
    an empty text. Pages without a host, and hosts with one page, are judged by their markup
    alone. Rows that repeat give rows that repeat. An empty table gives an empty result. Ids may
    have any type; other columns of `pages` are not read, so none can clash.

    Pages are numbered in that order and judged in blocks of BLOCK numbers, each with the pages
    beside it, so a host of any size is split and no result depends on where. Only hashes of
    lines move; texts are stored once, and a filter over the pages that lose lines lets no other
    text into the join that takes the lines out.
    """
    host, path = url_parts(F.col("url"))
    base = named(pages, id=id_col, url=url_col, html=html_col)
    placed = base.select("id", "url", host.alias("host"), path.alias("path"), "html")
    schema = f"{placed.drop('html').schema.toDDL()}, {_PAGE_COLUMNS}"
    lined = store(placed.mapInArrow(_parse, schema))
    keys = ["host", "path", "content"]
    contents = (
        lined.where("host <> ''").select(*keys, "marks", "body", "marked").dropDuplicates(keys)
    )
    numbered = _numbered(contents)
    block, place = F.expr(f"position div {BLOCK}"), F.col("position") % BLOCK
    blocks = F.array(
        block,
        F.when((place < WINDOW) & (block > 0), block - 1),
        F.when(place >= BLOCK - WINDOW, block + 1),
    )
    found = store(
        numbered.withColumn("block", F.explode(F.array_compact(blocks)))
        .withColumn("own", F.col("block") == block)
        .groupBy("block")
        .applyInArrow(
            _judge, "host string, path string, content binary, gone array<int>"
        )
    )
    mark = F.xxhash64(*keys)
    losing = key_filter(found.select(mark.alias("key")).distinct()).test(F.col("mark"))
    texts = lined.select("id", "url", "lines", *keys, mark.alias("mark"))
    moved = texts.where(losing).join(found, keys, "left")
    unmoved = texts.where(~losing).withColumn("gone", F.lit(None).cast("array<int>"))
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    left = F.filter("lines", lambda line, i: ~F.array_contains(gone, i))
    return (
        unmoved.unionByName(moved)
        .withColumn("text", F.array_join(left, "\n\n"))
        .select(
            F.col("id").alias(id_col),
            F.col("url").alias(url_col),
            "text",
            F.length("text").cast("long").alias("n_chars"),
            F.size(gone).cast("long").alias("n_template"),
        )
    )
