"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clustering.

The standard library's parser streams a page's events. A line is the text of one
block; its ratio is its characters outside links to its tags. Ratios, smoothed by
a Gaussian, are clustered by a threshold, their standard deviation, into content
and the rest. The content lines elect the region: the innermost element that
holds them. Of the region every line stays, short ones too, but for what the
markup names as something else (menus, adverts, forms, comments and the like).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelweave.llm.common import small_batches, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody "
    "tfoot thead title tr ul".split()
)
#: Elements whose text is never a reader's.
UNREAD = frozenset(
    "applet audio canvas datalist embed head iframe math noembed noframes noscript object picture script style svg template title "
    "video".split()
)
BESIDE = frozenset("aside button dialog fieldset footer form input label menu nav search select textarea".split())
BESIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split()
)
#: Words of a class or id that name what is beside an article.
BESIDE_WORDS = frozenset(
    "ad ads adslot adsense adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment "
    "commentlist comments consent cookie cookies copyright disclaimer discussion disqus footer gdpr masthead menu modal nav "
    "navbar navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted promotion "
    "recommended related replies reply respond share sharing sidebar sidenav signup skip social sponsor sponsored subscribe "
    "subscription tags teaser teasers toolbar widget widgets".split()
)
#: Words of a class or id that name a page's header, unless they say that it is an article's.
HEADER_WORDS = frozenset(["header", "topbar"])
ARTICLE_WORDS = frozenset("article content entry headline main post story text title".split())
#: Elements that a start tag ends when they are open, and the elements that hide them from it.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
SECTIONS = frozenset(["article", "main"])
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page(HTMLParser):
    """Lines and elements of a page, as its events come."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        #: Of each element: its parent, whether it is beside the text (2: by its tag, 1: by its names), whether it is a section.
        self.parent, self.beside, self.section, self.tag = [-1], [0], [False], [""]
        #: Open tags: name, the element that lines in it belong to, whether its text is left unread.
        self.open: list[tuple[str, int, bool]] = [("", 0, False)]
        self.unread = 0
        self.links = 0
        #: Of each line: its text, characters outside links, tags, element, whether it is a heading.
        self.lines: list[tuple[str, int, int, int, bool]] = []
        self._start()

    def _start(self) -> None:
        self.bits, self.plain, self.tags = [], 0, 0

    def _end_line(self) -> None:
        text = " ".join("".join(self.bits).split())
        if text:
            heading = any(tag == "h1" for tag, _, _ in self.open)
            self.lines.append((text, self.plain, self.tags, self.open[-1][1], heading))
            self._start()
        else:
            self.bits = []

    def _kind(self, tag: str, attrs: list) -> int:
        given = dict(attrs)
        role = (given.get("role") or "").lower()
        if tag in BESIDE or role in BESIDE_ROLES:
            return 2
        if "hidden" in given or (given.get("aria-hidden") or "").lower() == "true" or HIDDEN.search(given.get("style") or ""):
            return 2
        if tag == "header":
            return 0 if any(self.section[e] for _, e, _ in self.open) else 2
        if tag in ("html", "body"):
            return 0
        names = f"{given.get('class') or ''} {given.get('id') or ''}"
        words = {w.lower() for w in WORDS.findall(names)} | set(re.split(r"[\s_-]+", names.lower()))
        if words & BESIDE_WORDS or (words & HEADER_WORDS and not words & ARTICLE_WORDS):
            return 1
        return 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self._end_line()
            self._close("p")
        elif tag in ("br", "td", "th"):
            self.bits.append(" ")
        self.tags += 1
        if tag in ENDS:
            ended, walls = ENDS[tag]
            for k in range(len(self.open) - 1, 0, -1):
                name = self.open[k][0]
                if name in walls:
                    break
                if name in ended:
                    self._pop(k)
                    break
        if tag in VOID:
            return
        element, unread = self.open[-1][1], tag in UNREAD
        if tag in BLOCKS:
            self.parent.append(element)
            self.beside.append(self._kind(tag, attrs))
            self.section.append(tag in SECTIONS or dict(attrs).get("role") in SECTIONS)
            self.tag.append(tag)
            element = len(self.parent) - 1
        elif tag not in ("html", "td", "th"):
            unread = unread or self._kind(tag, attrs) > 0
        self.open.append((tag, element, unread))
        self.unread += unread
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        """A slash in a start tag closes nothing but drawings and the like."""
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.unread:
            self.handle_endtag(tag)

    def _pop(self, k: int) -> None:
        for name, _, unread in self.open[k:]:
            self.unread -= unread
            self.links -= name == "a"
        del self.open[k:]

    def _close(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                self._pop(k)
                return
            if tag == "p" and self.open[k][0] in BLOCKS:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
        elif tag in ("br", "td", "th"):
            self.bits.append(" ")
        self.tags += 1
        if tag not in VOID:
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] == tag:
                    self._pop(k)
                    break
                if tag not in BLOCKS and self.open[k][0] in BLOCKS:
                    break  # an inline end tag does not close a block

    def handle_data(self, data: str) -> None:
        if not self.unread:
            self.bits.append(data)
            if not self.links:
                self.plain += len(data.strip())

    def finish(self) -> None:
        self.close()
        self._end_line()


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Ratios under a Gaussian of this deviation, cut at three deviations, edges held."""
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def content_lines(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Which lines the threshold puts with the content: smoothed ratio at least the ratios' deviation."""
    flat = smoothed(ratios, sigma)
    return (flat >= min(float(flat.std()), float(flat.max()))) & (ratios > 0)


def main_text(html: str | None, sigma: float = 1.0, share: float = 0.7) -> str:
    """The article of a page, one block a line; empty if there is none."""
    if not html:
        return ""
    page = Page()
    page.feed(_finished(html))
    page.finish()
    lines, parent, n = page.lines, page.parent, len(page.parent)
    if not lines:
        return ""

    def summed(values: list) -> list:
        """Of each element the sum over it and all inside it."""
        for e in range(n - 1, 0, -1):
            values[parent[e]] += values[e]
        return values

    every, tops = [0] * n, [0] * n
    for _, plain, _, e, heading in lines:
        every[e] += plain
        tops[e] += heading
    summed(every), summed(tops)
    sound = summed([int(page.section[e] and not page.beside[e]) for e in range(n)])
    out = [False] * n
    for e in range(1, n):
        # names are not believed where an element holds the article itself
        holds = sound[e] or (tops[e] and every[e] > 0.6 * every[0])
        out[e] = out[parent[e]] or page.beside[e] == 2 or (page.beside[e] == 1 and not holds)
    ratios = np.array([0.0 if out[e] else plain / max(1, tags) for _, plain, tags, e, _ in lines])
    sure = content_lines(ratios, sigma).tolist()
    mass, heads = [0] * n, [0] * n
    for (_, plain, _, e, heading), is_content in zip(lines, sure):
        if not out[e]:
            mass[e] += plain if is_content else 0
            heads[e] += heading
    summed(mass), summed(heads)
    sections = [e for e in range(1, n) if page.section[e] and not out[e] and mass[e] and mass[e] >= 0.3 * mass[0]]
    if sections:
        most = max(sections, key=lambda e: mass[e])
        around = [e for e in sections if e == most or _within(most, {e}, parent) or _within(e, {most}, parent)]
        enough = [e for e in around if 2 * mass[e] >= mass[most]]
        region, menus = max(enough, key=lambda e: (heads[e] > 0, e)), set()
    else:
        region, menus = _descend(page, mass, heads, out, share), _menus(page, out)
    inside = [False] * n
    for e in range(n):
        inside[e] = e == region or (e > 0 and inside[parent[e]])
    return "\n".join(line[0] for line in lines if inside[line[3]] and not out[line[3]] and not _within(line[3], menus, parent))


def _finished(html: str) -> str:
    """The page without a comment or tag that its end cuts off."""
    comment = html.rfind("<!--")
    if comment > html.rfind("-->") and "</script" not in html[comment:].lower():
        html = html[:comment]
    tag = html.rfind("<")
    if tag > html.rfind(">") and (html[tag + 1 : tag + 2].isalpha() or html[tag + 1 : tag + 2] in ("/", "!", "?", "")):
        html = html[:tag]
    return html


def _descend(page: Page, mass: list[int], heads: list[int], out: list[bool], share: float) -> int:
    """The innermost element with this share of the content of those around it, which leaves no main heading behind."""
    inner: dict[int, int] = {}
    for e in range(1, len(mass)):
        if not out[e] and page.tag[e] not in LEAVES and mass[e] > mass[inner.get(page.parent[e], 0)] * (page.parent[e] in inner):
            inner[page.parent[e]] = e
    region = 0
    while (best := inner.get(region)) and mass[best] >= share * mass[region] and heads[best] == heads[region]:
        region = best
    return region


#: Blocks that hold a piece of an article, not an article.
LEAVES = frozenset("p li dt dd h1 h2 h3 h4 h5 h6 tr table tbody ul ol dl pre blockquote figure figcaption".split())


def _menus(page: Page, out: list[bool]) -> set[int]:
    """Lists of two links or more without other text."""
    plain, count = {}, {}
    for _, outside, _, e, _ in page.lines:
        while e > 0:
            if page.tag[e] in ("ul", "ol", "dl"):
                plain[e] = plain.get(e, 0) + outside
                count[e] = count.get(e, 0) + 1
            e = page.parent[e]
    return {e for e in plain if not plain[e] and count[e] > 1 and not out[e]}


def _within(e: int, chosen: set[int], parent: list[int]) -> bool:
    while chosen and e > 0:
        if e in chosen:
            return True
        e = parent[e]
    return False


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    sigma: float = 1.0,
    share: float = 0.7,
) -> DataFrame:
    """(id, url, text, n_chars) of each row: the main text, its blocks joined by line feeds.

    White space is what Unicode calls so, no-break spaces too; ``<br>`` and table
    cells part words, not blocks. Null and empty pages, and pages without an article,
    give an empty text. Pages of any length are read whole, one at a time. Rows stand
    for themselves: repeated rows repeat their result, and there are no ties. Other
    columns are not read. ``sigma`` is the Gaussian's deviation in lines, ``share``
    the part of the content that an element needs to be the region where no article
    or main element is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, sigma, share) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = pages.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, url string, text string, n_chars long")


def op12_html_text(spark: SparkSession, sf: str) -> DataFrame:
    small_batches(spark)
    return extract(table(spark, sf, "pages")).withColumnRenamed("id", "page_id")
