"""Main text of web pages: parser events, text-to-tag ratio per line, smoothing and clustering.

The standard library's event parser streams a page into lines (one for each block of text).  A line
carries its text-to-tag ratio, the share of its text in links, and the container that it stands in.
The ratios are smoothed with a Gaussian and clustered by a threshold (or are one cluster, if the two
means lie close).  Every article and main element, and every outermost div or the body around them that
holds clustered text, is a content region; every line of a region that is not furniture (menus, forms,
notices, adverts, comments ...) belongs to the main text - short paragraphs too.  Sections and table
cells belong to what holds them.  Outside articles, lines of links far below the threshold are menus.

Cases: a null or empty page, and one without a line that is more than links, has the empty text; repeated pages are extracted alike; other columns
pass through (in ``extract`` a column ``main_text`` is replaced); unclosed or truncated markup is closed where
the next block or the page ends, and an unclosed head where the body begins; marks of comments or tags that
never end are blanks, so that time stays in proportion to the page.  An element that is furniture by its names only (or a form) is not
dropped if it holds the page's articles, that is more text than is left without it.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm.common import batches, prepare, set_aside, table, texts_of

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main nav ol p pre section summary
table tbody td tfoot th thead title tr ul""".split())
DROPPED = frozenset("""script style noscript template svg annotation annotation-xml canvas object iframe head title nav footer
aside form button select textarea input label fieldset dialog menu audio video map""".split())
REGION = frozenset("article main".split())
#: Elements that the next one of their group closes.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
# Words of class, id and role names that mark furniture.
FURNITURE = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner
cookie cookies consent gdpr notice notices alert popup modal overlay sidebar side rail menu nav navbar navigation
breadcrumb breadcrumbs footer masthead topbar toolbar share sharing social related recommended recommendations
newsletter subscribe signup login search pagination pager comment comments disqus reply replies respond widget
contentinfo complementary skip hidden""".split())
#: Words that may stand beside those in a compound name (`sidebar-left`, not `has-sidebar` or `social-science`).
BESIDE = frozenset("""left right top bottom upper lower first last primary secondary main side inner outer box block
wrap wrapper container section area zone region list item items link links bar button buttons icon icons post posts
page site global unit slot form widget widgets panel message header footer body text title inline sticky fixed mobile
desktop small large js id article articles content story stories news blog user users reader readers visitor guest member
privacy policy law legal eu gdpr info information this that it us our your all more also new old count counter number
thread threads tree root row col column group holder module view label heading toggle top2 nojs print email facebook
twitter""".split())
#: What may stand in a head; anything else begins the body.
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
HEADERS = frozenset("header site-header page-header".split())
#: Standard deviation of the Gaussian, in lines.
SIGMA = 1.0
#: Means of the smoothed ratios that differ by less than this factor are one cluster.
APART = 2.0
#: Share of link text above which a line outside articles and far below the threshold is a menu.
LINK_SHARE = 0.6
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_TOKEN = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")
#: What a comment ends with, and what else may be left open to the end of a page.
_COMMENT_END = re.compile(r"--!?>")


def named(word: str) -> bool:
    """Whether a class, id or role name is that of furniture: as a whole, or in all its parts (at signs and capitals)."""
    parts = {p for p in _TOKEN.split(_CAMEL.sub("-", word).lower()) if p and not p.isdigit()}
    return word.lower() in FURNITURE or (bool(parts & FURNITURE) and parts <= FURNITURE | BESIDE)


def closed(html: str) -> str:
    """The page without the marks of comments, tags and declarations that never end, for which the parser would look to
    the end of the page again and again; their content stays, as text."""
    last = 0
    for m in _COMMENT_END.finditer(html):
        last = m.end()
    if "<!--" in html[last:]:
        html = html[:last] + html[last:].replace("<!--", " ")
    end = html.rfind(">") + 1
    if "<" in html[end:]:
        html = html[:end] + html[end:].replace("<", " ")
    return html


def furniture(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> bool:
    """Whether an element starts something other than main text; ``inside``: within an article."""
    if tag in DROPPED or (tag == "header" and not inside):
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    for name, value in attrs:
        words, value = (value or "").split(), (value or "").lower()
        if name in ("class", "id", "role"):
            if any(map(named, words)):
                return True
            if not inside and any(w.lower() in HEADERS for w in words):
                return True
        elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and _HIDDEN.search(value)):
            return True
    return False


class Lines(HTMLParser):
    """Streams a page into lines of (text, tags, link characters, container)."""

    def __init__(self, spared: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int]] = []  # element, whether it drops its text, container
        self.places: dict[str, list[int]] = defaultdict(list)  # where the open elements of a name stand in it
        self.blocks: list[int] = []  # where the open block elements stand
        self.dropping = self.hard = 0  # open elements that drop their text; of these, those that always do
        self.spared = spared  # elements by number that do not drop their text
        self.elements = 0
        self.soft: list[tuple[int, int]] = []  # (number, depth) of the open elements that may be spared
        self.around: set[int] = set()  # those that hold an article or main
        self.lost = 0  # characters of articles in them
        self.sections = True  # whether a CDATA section may still end
        self.regions = 0
        self.links = 0
        self.containers = 0
        self.articles: set[int] = set()  # containers that are article or main elements
        self.text: list[str] = []
        self.tags = self.linked = 0
        self.lines: list[tuple[str, int, int, int]] = []

    def parse_marked_section(self, i, report=1):
        """A marked section ends as CDATA does, any other (or one without that end) at the next closing sign."""
        end = self.rawdata.find("]]>", i) if self.sections and self.rawdata.startswith("<![CDATA[", i) else -1
        if end < 0:
            self.sections &= not self.rawdata.startswith("<![CDATA[", i)  # none behind this one either
            end = self.rawdata.find(">", i) - 2
        return end + 3 if end >= -1 else -1

    def _container(self) -> int:
        return self.open[-1][2] if self.open else 0

    def _line(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append((text, self.tags, self.linked, self._container()))
        self.text, self.tags, self.linked = [], 0, 0

    def _pop(self) -> None:
        tag, drops, _ = self.open[-1]
        if drops and self.soft and self.soft[-1][1] == len(self.open):
            self.soft.pop()
        elif drops:
            self.hard -= 1
        if tag in BLOCK:
            self._line()
            self.blocks.pop()
        self.open.pop()
        self.places[tag].pop()
        self.dropping -= drops
        self.regions -= tag in REGION
        self.links -= tag == "a"

    def _close(self, tags: set[str], until: frozenset[str]) -> None:
        """Close the innermost of ``tags`` and what is open inside it, if no element of ``until`` is between."""
        last = lambda names: max((self.places[t][-1] for t in names if self.places.get(t)), default=-1)
        at = last(tags)
        if at > last(until - tags):
            while len(self.open) > at:
                self._pop()

    def _body(self, tag: str) -> None:
        """Close a head that is still open where ``tag`` or text begins the body."""
        if tag == "body" or (tag not in IN_HEAD and tag != "head" and self.open and self.open[-1][0] == "head"):
            self._close({"head"}, frozenset(("body",)))

    def handle_starttag(self, tag, attrs):
        self._body(tag)
        self.tags += 1
        if tag in BLOCK:
            if self.blocks and self.open[self.blocks[-1]][0] == "p":
                self._close({"p"}, frozenset())
            self._line()
            self.tags += 1
        if tag in CLOSES:
            self._close(CLOSES[tag], frozenset(("ul", "ol", "dl", "table", "select")))
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                self.text.append(" " if tag != "wbr" else "")
            return
        self.elements += 1
        drops = furniture(tag, attrs, self.regions > 0) and self.elements not in self.spared
        if drops and (tag == "form" or tag not in DROPPED and tag != "header"):
            self.soft.append((self.elements, len(self.open) + 1))
        elif drops:
            self.hard += 1
        if tag in REGION and not self.hard:
            self.around |= {n for n, _ in self.soft}
        container = self._container()
        if not self.regions and (tag in REGION or (tag == "div" and not container)):
            self.containers += 1
            container = self.containers
            if tag in REGION:
                self.articles.add(container)
        self.places[tag].append(len(self.open))
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append((tag, drops, container))
        self.dropping += drops
        self.regions += tag in REGION
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "p" and not self.places.get("p"):
            self._line()
        elif tag == "br":
            self.text.append(" ")
        else:
            self._close({tag}, frozenset(("td", "th", "table")) if tag in ("b", "i", "em", "strong", "span", "a", "p") else frozenset())

    def handle_data(self, data):
        if data.strip():
            self._body("")
        if self.soft and self.regions and not self.hard:
            self.lost += len(data.strip())
        if not self.dropping:
            self.text.append(data)
            if self.links:
                self.linked += len(data.strip())

    def finish(self) -> list[tuple[str, int, int, int]]:
        self.close()
        while self.open:
            self._pop()
        self._line()
        return self.lines


def content_lines(ratios: np.ndarray, sigma: float = SIGMA) -> tuple[np.ndarray, np.ndarray]:
    """Lines whose smoothed ratio lies above the threshold between the two clusters, and whose own ratio comes near it."""
    if not len(ratios):
        return np.zeros(0, bool), np.zeros(0, bool)
    reach = int(3 * sigma) or 1
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    smooth = np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), "valid")
    low, high = smooth.min(), smooth.max()
    for _ in range(20):  # two means on a line: the threshold is their middle
        cut = (low + high) / 2
        above = smooth >= cut
        new = (smooth[~above].mean() if (~above).any() else low, smooth[above].mean())
        if new == (low, high):
            break
        low, high = new
    cut = (low + high) / 2
    return (smooth >= cut) | (low * APART >= high), ratios * APART >= cut


def main_text(html: str) -> str:
    """The main text of one page: its blocks, in page order, joined by line breaks."""
    html = closed(html)
    parser = Lines()
    parser.feed(html)
    lines = parser.finish()
    if parser.around and parser.lost > sum(len(t) for t, *_ in lines):
        parser = Lines(frozenset(parser.around))
        parser.feed(html)
        lines = parser.finish()
    if not lines:
        return ""
    chosen, dense = content_lines(np.array([len(t) / max(1, tags) for t, tags, _, _ in lines]))
    held = {c for (text, _, linked, c), above in zip(lines, chosen.tolist(), strict=True) if above and linked < len(text)}
    regions = held | parser.articles
    kept = [t for (t, _, linked, c), own in zip(lines, dense.tolist(), strict=True)
            if c in regions and (own or c in parser.articles or linked <= LINK_SHARE * len(t))]
    return "\n".join(kept)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` plus ``main_text``."""
    prepare(pages.sparkSession)
    pages, back = set_aside(pages.drop("main_text"))
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([main_text(h) for h in texts_of(b, html)], pa.string())],
                                             schema=pa.schema([*b.schema, pa.field("main_text", pa.string())]))

    return pages.mapInArrow(run, f"{own}, main_text string").select(*back, "main_text")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: its main text and the number of its code points."""
    found = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
