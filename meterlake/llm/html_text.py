"""Main text of HTML pages by line-block distribution.

Markup is stripped into lines, one for each block element. Lines of menus, adverts, forms and the like
count as empty. Text lengths are summed over sliding windows of lines: where the sum rises from nothing
is a surge point, where it falls to nothing a dive point, and the text between is a region. The region
with the most text is the main one; regions of the same article belong to it, and on a page without one the
other long regions (the parts of a text on both sides of an advert).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
#: Outside an article, a line with a greater share of link text counts as empty.
LINK_SHARE = 0.5

# Names of HTML elements and of the parts of a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
DROPPED = RAW | set(
    "head nav footer aside form button select option menu dialog svg math canvas object audio video "
    "fieldset datalist applet map".split()
)
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
HINTS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie "
    "cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup login menu nav "
    "navbar navigation breadcrumb breadcrumbs sidebar rail widget widgets related recommended recommendations "
    "share sharing social comment comments commentlist disqus reply replies respond responses footer masthead "
    "toolbar topbar search pagination pager skip hidden sr visually announcement alert copyright".split()
)
MAIN = {"article", "main"}
#: Blocks that are a part of the text around them rather than a container of their own.
PARTS = set("p li h1 h2 h3 h4 h5 h6 html body ul ol dl dt dd table tbody thead tfoot tr caption blockquote pre section "
            "figure figcaption details summary hgroup address".split())
#: Without attributes these are never noise.
PLAIN = BLOCKS - DROPPED - {"header"}
#: An element with a hint among other words in its name is noise if its text is shorter or mostly links.
SHORT = 200
#: Start tags that end an open element of the same kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}}
CLOSES |= {"th": CLOSES["td"], "option": {"option"}}

#: A name with one of these parts, alone or among others, is noise unless it holds nearly all text of the page.
STRONG = set("comment comments commentlist disqus cookie cookies consent gdpr newsletter related footer".split())
NEARLY_ALL = 0.95
#: Beside one of these a hint tells what an element has, not what it is.
ASIDE = set("has with without no show hide open closed enabled disabled".split())
#: A region belongs to the main text of a page without article if it has this share of the longest one, or this many characters.
LONG_SHARE, LONG = 0.25, 500

_START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
NOISE, WEAK, STRONG_HINT, TEXT = "noise", "weak", "strong", "text"


def _judged(tag: str, attributes: str, inside_main: bool) -> str:
    """NOISE, or TEXT, or how a part of the name hints at noise, so that the element's text decides."""
    hint = TEXT
    if tag in DROPPED or tag == "header" and not inside_main:
        return NOISE
    if not attributes.strip() or tag in ("html", "body"):
        return TEXT
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id"):
            parts = set(re.split(r"[^a-z]+", value)) - {""}
            if parts & HINTS and not (tag in MAIN and not parts & (STRONG | {"ad", "ads"})):
                if parts <= HINTS:
                    return NOISE
                hint = STRONG_HINT if parts & STRONG and not parts & ASIDE or hint == STRONG_HINT else WEAK
        elif name == "role" and value in ROLES or name == "hidden":
            return NOISE
        elif name == "aria-hidden" and value == "true":
            return NOISE
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return NOISE
    return hint


def _tag_end(page: str, at: int) -> int:
    """The position of the ``>`` that ends the tag whose attributes begin at ``at``, outside quotes; -1 if none."""
    while True:
        end = page.find(">", at)
        if end < 0:
            return -1
        quote = min((q for q in (page.find('"', at, end), page.find("'", at, end)) if q >= 0), default=-1)
        if quote < 0:
            return end
        closing = page.find(page[quote], quote + 1)
        if closing < 0:
            return end  # a quote that is never closed is no quote
        at = closing + 1


class _Lines:
    """Lines of a page with running totals, and the tree of its containers. Each element costs the same, however deep."""

    def __init__(self):
        self.text: list[str] = []
        self.counts: list[int] = []  # characters that count
        self.where: list[int] = []
        # Totals before each line: characters, characters in links, lines of articles.
        self.before: list[tuple[int, int, int]] = [(0, 0, 0)]
        # Containers: the parent, the depth, and whether they are an article.
        self.parent, self.depth, self.main = [-1], [0], [False]

    def container(self, parent: int, main: bool) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.main.append(main)
        return len(self.parent) - 1

    def add(self, text: str, linked: int, where: int) -> None:
        main = self.main[where]
        self.text.append(text)
        # An article's lines count in full; elsewhere lists of links are menus.
        self.counts.append(len(text) if main or linked <= LINK_SHARE * len(text) else 0)
        self.where.append(where)
        size, links, mains = self.before[-1]
        self.before.append((size + len(text), links + linked, mains + main))

    def gap(self) -> None:
        for _ in range(WINDOW):
            self.text.append("")
            self.counts.append(0)
            self.where.append(0)
            self.before.append(self.before[-1])

    def since(self, line: int) -> tuple[int, int, int]:
        """Characters, characters in links, lines of articles since a line."""
        return tuple(now - then for now, then in zip(self.before[-1], self.before[line], strict=True))

    def cut(self, line: int) -> None:
        for rows in (self.text, self.counts, self.where):
            del rows[line:]
        del self.before[line + 1 :]

    def blank(self, begin: int, end: int) -> None:
        """Lines that turned out to be noise count as empty."""
        for i in range(begin, end):
            self.text[i], self.counts[i] = "", 0


def lines(page: str) -> _Lines:
    """The page's lines with their containers; noise leaves empty lines."""
    out = _Lines()
    # Open elements: tag, noise, container, hint, lines and pieces before.
    stack: list[tuple[str, bool, int, str, int, int]] = []
    blocks: list[int] = []  # places of the open block elements in the stack
    opened: Counter = Counter()
    pieces: list[str] = []
    sizes: list[tuple[int, int]] = [(0, 0)]  # characters, and those in links, before each piece
    strong: list[tuple[int, int]] = []

    def noise() -> bool:
        return bool(stack) and stack[-1][1]

    def container() -> int:
        return stack[-1][2] if stack else 0

    def end_line() -> None:
        if not pieces:
            return
        text = " ".join("".join(pieces).split())
        if text:
            out.add(text, sizes[-1][1], container())
        pieces.clear()
        del sizes[1:]

    def add(text: str) -> None:
        if text and not noise():
            text = html.unescape(text)
            size = len(text.strip())
            pieces.append(text)
            sizes.append((sizes[-1][0] + size, sizes[-1][1] + (size if opened["a"] else 0)))

    def weigh(hint: str, line: int, piece: int) -> None:
        """Take out an element that its text proves to be noise."""
        if len(out.text) == line:
            piece = min(piece, len(pieces))
            size, links = (now - then for now, then in zip(sizes[-1], sizes[piece], strict=True))
            if hint == STRONG_HINT or size < SHORT or links > LINK_SHARE * size:
                del pieces[piece:], sizes[piece + 1 :]
            return
        size, links, mains = out.since(line)
        if mains and not out.main[container()]:
            if hint == STRONG_HINT:
                strong.append((line, len(out.text)))
        elif size < SHORT or links > LINK_SHARE * size:
            out.cut(line)
            out.gap()
        elif hint == STRONG_HINT:
            strong.append((line, len(out.text)))
            out.gap()

    def close(i: int) -> None:
        # From the innermost element, so that each one's line ends before its text is weighed.
        while len(stack) > i:
            tag, silent, _, hint, line, piece = stack[-1]
            if tag in BLOCKS and not silent:
                end_line()
            if hint in (WEAK, STRONG_HINT):
                above = stack.pop()
                weigh(hint, line, piece)
                stack.append(above)
            if blocks and blocks[-1] == len(stack) - 1:
                blocks.pop()
            opened[tag] -= 1
            stack.pop()

    at = 0
    while at < len(page):
        token = _START.search(page, at)
        if token is None:
            add(page[at:])
            break
        begin = token.start()
        if token[0] in ("<!--", "<!", "<?"):
            add(page[at:begin])
            end = page.find("-->", begin + 4) + 2 if token[0] == "<!--" else page.find(">", begin)
            at = end + 1 if end > begin else len(page)
            continue
        closing = token[0][1] == "/"
        name = _NAME.match(page, begin + 1 + closing)
        end = page.find(">", name.end()) if closing else _tag_end(page, name.end())
        if end < 0:
            add(page[at:])
            break
        add(page[at:begin])
        at = end + 1
        tag = name[0].lower()
        if closing:
            if opened[tag]:
                i = len(stack) - 1
                while stack[i][0] != tag:
                    i -= 1
                close(i)
            continue
        if tag in VOID:
            if tag == "hr" and not noise():
                end_line()
            elif tag == "br":
                add(" ")
            continue
        ends = CLOSES.get(tag, set()) | ({"p"} if tag in BLOCKS and tag not in ("td", "th", "tr") else set())
        # Only the innermost block can be ended by a start tag, or an option above it.
        if blocks and stack[blocks[-1]][0] in ends:
            close(blocks[-1])
        elif stack and stack[-1][0] in ends:
            close(len(stack) - 1)
        inside = out.main[container()]
        hint = _judged(tag, page[name.end() : end], inside) if end > name.end() or tag not in PLAIN else TEXT
        was_noise = noise()
        if not was_noise and (tag in BLOCKS or hint == NOISE and tag in DROPPED):
            end_line()
            if hint == NOISE:
                out.gap()
        where = container()
        if tag in MAIN and not inside:
            where = out.container(where, True)
        elif not inside and tag in BLOCKS and tag not in PARTS:
            where = out.container(where, False)
        if tag in RAW:
            after = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = after.end() if after else len(page)
            continue
        if tag in BLOCKS:
            blocks.append(len(stack))
        opened[tag] += 1
        silent = was_noise or hint == NOISE
        stack.append((tag, silent, where, TEXT if silent else hint, len(out.text), len(pieces)))
    if not noise():
        end_line()
    close(0)
    whole, done = out.before[-1][0], 0
    for first, last in sorted(strong, key=lambda s: (s[0], -s[1])):  # outer elements first
        if last > done and out.before[last][0] - out.before[first][0] < NEARLY_ALL * whole:
            out.blank(first, last)
            done = last
    return out


def _home(out: _Lines, low: int, high: int) -> int:
    """The container with most of the text of a region."""
    weight: Counter = Counter()
    for i in range(low, high):
        weight[out.where[i]] += out.counts[i]
    return weight.most_common(1)[0][0]


def _ancestor(out: _Lines, a: int, b: int) -> int:
    while a != b:
        if out.depth[a] < out.depth[b]:
            a, b = b, a
        a = out.parent[a]
    return a


def main_text(page: str | None) -> str:
    """The main text of one page; see ``extract``."""
    out = lines(page or "")
    counts = out.counts
    sums, total = [], sum(counts[:WINDOW])
    for i in range(len(counts)):
        sums.append(total)
        total += (counts[i + WINDOW] if i + WINDOW < len(counts) else 0) - counts[i]
    regions, begin = [], None
    for i, total in enumerate(sums):
        if total and begin is None:
            begin = i  # surge
        elif not total and begin is not None:
            regions.append((begin, i))  # dive
            begin = None
    if begin is not None:
        regions.append((begin, len(counts)))
    if not regions:
        return ""
    size = {r: sum(counts[r[0] : r[1]]) for r in regions}
    main = max(regions, key=size.get)
    home = _home(out, *main)
    if out.main[home]:
        kept = [out.text[i] for a, b in regions for i in range(a, b) if counts[i] and out.where[i] == home]
        return "\n".join(kept)
    # The parts of a text on both sides of an advert may be containers of their own: the home of all long regions,
    # and of them the text that stands in such a part, or in a container around it.
    long = [r for r in regions if size[r] >= min(LONG, LONG_SHARE * size[main]) and r != main]
    homes = {home} | {h for r in long if not out.main[h := _home(out, *r)]}
    top = home
    for other in homes:
        top = _ancestor(out, top, other)
    around = {top}
    for part in homes:
        while part != top:
            around.add(part)
            part = out.parent[part]
    inside = [0 in homes]
    for c in range(1, len(out.parent)):
        inside.append(c in homes or inside[out.parent[c]])
    whole = {main, *(r for r in long if _home(out, *r) in homes)}
    kept = []
    for region in regions:
        for i in range(*region):
            if counts[i] and (region in whole or inside[out.where[i]] or len(homes) > 1 and out.where[i] in around):
                kept.append(out.text[i])
    return "\n".join(kept)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars (code points).

    Lines are joined in page order by a newline; white space inside a line is one space; character
    references are decoded. A null or empty page, or one without main text, has an empty text. Repeated
    rows and null ids stay as they are. Other columns are not read.
    """
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    schema = rows.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(_extracted, schema)
