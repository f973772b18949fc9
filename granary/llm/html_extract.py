"""HTML extraction: nearest-URL page differencing.

Pages of one host are sorted by URL path, and each is paired with the nearer of
its two neighbours among the pages whose wanted lines are not all the same as
its own: a copy under another id, query string or scheme tells nothing about the
template. The text lines of a pair are aligned by a longest common subsequence,
and the lines a page shares with its partner, which come from the site's
template, are deleted.

Page marks settle what differencing alone cannot. Elements that say they are a
menu, header, footer, sidebar, notice, advert, form, script, style or comment
are dropped whether or not a partner shows the same lines; where a page marks
its article, only the article's lines are wanted, and those stay even if the
partner has them too, for copied articles and passages do recur within a host.

Neighbours are found in slices of one range-partitioned sort, whose ends are
patched from a table of one row a slice, so a host of any size is no task of
its own. What is sorted, paired and aligned are line hashes; the wanted
lines move once, to meet the numbers of those that are shared.

Defined results: a null or empty page has an empty text; a page of any length
is read whole, in time in proportion to it however its tags are broken; a ``<``
that ends nowhere is text; a null or unreadable URL belongs to the host without name; a host's only page loses no line, nor
do pages of a host that are all copies of one; rows
equal in id, URL and HTML are one page to the pairing and each keep their row;
null ids stay null; an empty table gives an empty result. Input columns named
like an added one are replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary import session
from granary.llm import text as T
from granary.llm.frames import shielded, without

TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/<>\"']*)")
TAG_STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w:-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
CAMEL = re.compile(r"([a-z])([A-Z])")
RAW_END = {name: re.compile(f"</{name}", re.IGNORECASE) for name in ("script", "style", "textarea", "title")}

# Element and mark names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
UNSEEN = frozenset("head noscript template iframe object svg math canvas audio video datalist".split())
NOISE = frozenset("nav menu aside footer form button select fieldset dialog".split())
NOISE_MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs sidebar cookie cookies consent gdpr notice notices popup modal "
    "footer overlay newsletter subscribe subscription signup comment comments commentlist respond reply replies disqus share "
    "sharing social related recommended recommendations pagination pager toolbar search complementary contentinfo".split()
)
# words that say where a mark stands, not what it is about: comment-list is a comment, share-price is no share
LAYOUT_WORDS = frozenset(
    "area bar block body box button buttons card cards container content div field fields form inner item items link links "
    "list outer panel post posts section slot thread top bottom left right text title unit widget wrap wrapper".split()
)
CONTAINERS = frozenset("div section span ul ol dl center figure details article main".split())
OUTER_MARKS = frozenset("header masthead topbar side widget widgets copyright".split())
COMMENT_MARKS = frozenset("comment comments reply replies respond ad advert sponsored related promo".split())
# names that only tell a layout, as in has-sidebar or comments-open
STATES = frozenset("has with no without is not open closed enabled disabled".split())
# an element of the first kind ends when one of the second begins beside it
CLOSED_BY = {
    "p": BLOCKS - {"button"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "option": {"option"},
    "head": {"body"},
}
SCOPE = frozenset("table ul ol dl article section main div body html td th blockquote select".split())

UNWANTED, OPEN, MAIN, ARTICLE = -1, 0, 1, 2


CLOSERS = {name: [first for first, by in CLOSED_BY.items() if name in by] for name in set().union(*CLOSED_BY.values())}


def _marks(source: str) -> tuple[list[tuple[set[str], bool]], bool, str]:
    """Words of each class, id and role, and whether it is an id; whether the element is hidden; its item property."""
    marks, hidden, prop = [], False, ""
    for name, double, single, bare in ATTRIBUTE.findall(source):
        value, name = double or single or bare, name.lower()
        if name in ("class", "id", "role"):
            for mark in value.split():
                parts = {part for part in re.split(r"[^a-z]+", CAMEL.sub(r"\1-\2", mark).lower()) if part}
                if not STATES & parts:
                    marks.append((parts, name == "id"))
            continue
        value = value.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style" and "display:none" in value.replace(" ", ""):
            hidden = True
        elif name == "itemprop":
            prop = value
    return marks, hidden, prop


def _wholly(marks: list[tuple[set[str], bool]], noise: frozenset[str]) -> bool:
    """Whether a mark speaks of noise and of nothing else."""
    return any(words & noise and words <= noise | LAYOUT_WORDS for words, _ in marks)


def _is_noise(name: str, marks: list[tuple[set[str], bool]], outer: int) -> bool:
    """Whether the marks make the element boilerplate.

    Around the article any word of a container's marks counts. Inside it, where
    ids and classes are often cut from headings and subjects, only marks that
    are noise as a whole do, and only on containers; headings, paragraphs and
    tables are never told by their ids.
    """
    if name in ("article", "main"):
        return _wholly(marks, COMMENT_MARKS)
    if name not in CONTAINERS:
        return outer < MAIN and _wholly([mark for mark in marks if not mark[1]], NOISE_MARKS)
    if outer >= MAIN:
        return _wholly(marks, NOISE_MARKS)
    return any(words & NOISE_MARKS for words, _ in marks)


def _kind(name: str, source: str, outer: int, in_header: bool) -> tuple[int, bool]:
    """What the text right inside an element is, given what surrounds it; whether it is an article's header."""
    if outer == UNWANTED:
        if in_header and name in HEADINGS:
            return ARTICLE, False
        return UNWANTED, in_header
    if name in NOISE:
        return UNWANTED, False
    if name in ("html", "body"):
        return outer, False
    marks, hidden, prop = _marks(source) if source.strip() else ([], False, "")
    if hidden or _is_noise(name, marks, outer):
        return UNWANTED, False
    if name == "header":
        return UNWANTED, outer == ARTICLE
    if outer < MAIN and name in CONTAINERS and any(words & OUTER_MARKS for words, _ in marks):
        return UNWANTED, False
    if name == "article" or prop == "articlebody":
        return ARTICLE, False
    if name == "main" or name in ("div", "section") and any("main" in words for words, _ in marks):
        return max(outer, MAIN), False
    return outer, False


class Tags:
    """The tags of a page one after another, each character looked at a bounded number of times.

    A tag ends at the first ``>`` outside quotes; a ``<`` without such an end is
    text. What a search found, or found missing, is remembered, so that a page
    of open tags or quotes costs no more than another.
    """

    def __init__(self, page: str):
        self.page = page
        self.searched, self.stop = 0, -1  # no > or quote lies between them; the second is the next one
        self.dead: set[int] = set()  # quotes from which no tag end is reached
        self.plain_end = True  # whether some > is left for <! and <?

    def _next_stop(self, at: int) -> int:
        if not self.searched <= at <= self.stop:
            found = TAG_STOP.search(self.page, at)
            self.searched, self.stop = at, found.start() if found else len(self.page)
        return self.stop

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes begin at ``at``, -1 without one."""
        opened = []
        while True:
            at = self._next_stop(at)
            if at == len(self.page):
                break
            if self.page[at] == ">":
                return at
            if at in self.dead:
                break
            opened.append(at)
            at = self.page.find(self.page[at], at + 1) + 1
            if not at:
                break
        self.dead.update(opened)
        return -1

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start and end of the next tag from ``at``, a slash if it is an end tag, its name and its attributes."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), "", "", ""
            if page.startswith(("<!", "<?"), start):
                end = page.find(">", start) if self.plain_end else -1
                if end >= 0:
                    return start, end + 1, "", "", ""
                self.plain_end = False
            elif (m := TAG_NAME.match(page, start)) and (end := self._end(m.end())) >= 0:
                return start, end + 1, m[1], m[2].lower(), page[m.end() : end]
            at = start + 1
        return None


class Stack:
    """The open elements, with what is asked of them at hand: where a name, a block or a scope was opened last."""

    def __init__(self):
        self.elements: list[tuple[str, int, bool]] = []  # name, kind, inside an article's header
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.scopes: list[int] = []

    def push(self, name: str, kind: int, in_header: bool) -> None:
        depth = len(self.elements)
        self.elements.append((name, kind, in_header))
        self.places.setdefault(name, []).append(depth)
        if name in BLOCKS:
            self.blocks.append(depth)
        if name in SCOPE:
            self.scopes.append(depth)

    def last(self, name: str) -> int:
        return places[-1] if (places := self.places.get(name)) else -1

    def cut(self, depth: int) -> tuple[int, bool]:
        """Close all elements from ``depth``; the kind of what is open then."""
        for name, _, _ in reversed(self.elements[depth:]):
            self.places[name].pop()
        del self.elements[depth:]
        for listed in (self.blocks, self.scopes):
            while listed and listed[-1] >= depth:
                listed.pop()
        return self.elements[-1][1:] if self.elements else (OPEN, False)


def lines_of(page: str) -> list[tuple[str, int]]:
    """The page's text blocks in order, white space collapsed, each with its kind."""
    lines: list[tuple[str, int]] = []
    held: list[str] = []
    tags, stack = Tags(page), Stack()
    kind, in_header, at = OPEN, False, 0

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                lines.append((text, kind))
            held.clear()

    while tag := tags.after(at):
        start, end, slash, name, source = tag
        if start > at:
            held.append(page[at:start])
        at = end
        if not name:
            continue
        if slash:
            if name in BLOCKS:
                flush()
            depth = stack.last(name)
            # an inline end tag does not reach through a block
            if depth >= 0 and (name in BLOCKS or not stack.blocks or stack.blocks[-1] < depth):
                if stack.blocks and stack.blocks[-1] >= depth:
                    flush()
                inner, header = stack.cut(depth)
                if inner != kind:
                    flush()
                kind, in_header = inner, header
            continue
        empty = source.endswith("/")
        if name in RAW_END or name in UNSEEN and name != "head":
            if not empty or name in RAW_END:
                pattern = RAW_END.get(name) or re.compile(f"</{re.escape(name)}", re.IGNORECASE)
                found = pattern.search(page, at)
                close_at = page.find(">", found.start()) if found else -1
                at = close_at + 1 if close_at >= 0 else len(page)
            continue
        if name in VOID:
            if name == "hr":
                flush()
            held.append(" ")
            continue
        if name in BLOCKS:
            flush()
        if name in CLOSERS:
            depth = max(stack.last(first) for first in CLOSERS[name])
            if depth >= 0 and depth >= (stack.scopes[-1] if stack.scopes else -1):
                kind, in_header = stack.cut(depth)
        if empty and name not in BLOCKS:
            continue
        inner, header = (UNWANTED, False) if name == "head" else _kind(name, source, kind, in_header)
        if inner != kind:
            flush()
        stack.push(name, inner, header)
        kind, in_header = inner, header
    held.append(page[at:])
    flush()
    return lines


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < min(len(a), len(b)) - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    in_a, in_b = set(a), set(b)
    left = [i for i in range(start, len(a) - stop) if a[i] in in_b]
    right = [x for x in b[start : len(b) - stop] if x in in_a]
    middle = [left[i] for i in _common([a[i] for i in left], right)]
    return [*range(start), *middle, *range(len(a) - stop, len(a))]


CELLS = 1 << 28


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """A row of the table of common lengths after each of ``a``: bit j is clear where it grows at ``b[j]``."""
    masks: dict[int, int] = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for x in a:
        hit = row & masks.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _common(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) > CELLS and len(a) > 1:  # halve, so that no table of that size is held
        middle = len(a) // 2
        head = head_back = 0
        for head in _rows(a[:middle], b):
            pass
        for head_back in _rows(a[:middle - 1 : -1], b[::-1]):
            pass
        grows = [not head >> j & 1 for j in range(len(b))]
        grows_back = [not head_back >> j & 1 for j in range(len(b))]
        best, cut, reach = -1, 0, 0
        back = sum(grows_back)
        for j in range(len(b) + 1):
            if reach + back > best:
                best, cut = reach + back, j
            if j < len(b):
                reach += grows[j]
                back -= grows_back[len(b) - 1 - j]
        return _common(a[:middle], b[:cut]) + [middle + i for i in _common(a[middle:], b[cut:])]
    rows = list(_rows(a, b))
    i, j, found = len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        elif i > 1 and not rows[i - 2] >> (j - 1) & 1:
            i -= 1
        else:
            found.append(i - 1)
            i, j = i - 1, j - 1
    return found[::-1]


def _hash(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


HASHED = "struct<lines:array<bigint>,content:bigint>"
ARROW_HASHED = pa.struct([("lines", pa.list_(pa.int64())), ("content", pa.int64())])


def line_hashes(page: str) -> dict:
    """Hashes of the page's lines, and one of its wanted lines together, which copies have in common."""
    lines = lines_of(page)
    hashes = [_hash(line) for line, _ in lines]
    wanted = max(OPEN, max((kind for _, kind in lines), default=OPEN))
    return {"lines": hashes, "content": _hash(" ".join(str(x) for x, (_, kind) in zip(hashes, lines) if kind == wanted))}


def _line_hashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in batches:
        yield pa.array([line_hashes(page.as_py() or "") for page in pages], ARROW_HASHED)


def _shared(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for own, partner in batches:
        pairs = zip(own.to_pylist(), partner.to_pylist())
        yield pa.array([common(a, b) if a and b else [] for a, b in pairs], pa.list_(pa.int32()))


def wanted_lines(page: str) -> tuple[str | None, list[str | None], list[int]]:
    """The text if the page marks its article; else its lines, those unwanted empty, and the wanted ones' places."""
    lines = lines_of(page)
    wanted = max((kind for _, kind in lines), default=UNWANTED)
    if wanted in (UNWANTED, ARTICLE):
        return "\n".join(line for line, kind in lines if kind == wanted == ARTICLE), [], []
    places = [i for i, (_, kind) in enumerate(lines) if kind == wanted]
    return None, [line if kind == wanted else None for line, kind in lines], places


def main_text(page: str, shared: list[int]) -> str:
    """The wanted lines without those at the ``shared`` places, unless the page marks them as its article."""
    text, lines, places = wanted_lines(page)
    return text if text is not None else "\n".join(lines[i] for i in places if i not in shared)


FOUND = "struct<text:string,lines:array<string>,places:array<int>>"
ARROW_FOUND = pa.struct(
    [("text", pa.string()), ("lines", pa.list_(pa.string())), ("places", pa.list_(pa.int32()))]
)


def _wanted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in batches:
        rows = [dict(zip(("text", "lines", "places"), wanted_lines(page.as_py() or ""))) for page in pages]
        yield pa.array(rows, ARROW_FOUND)


def nearness(path: str, other: str | None) -> int:
    """Length of the common beginning of two paths, -1 without another."""
    if other is None:
        return -1
    low, high = 0, min(len(path), len(other))
    while low < high:
        middle = (low + high + 1) // 2
        if path[low:middle] == other[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _earlier_nearer(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for columns in batches:
        paths = zip(*(column.to_pylist() for column in columns))
        yield pa.array([nearness(path, before) >= nearness(path, after) for path, before, after in paths], pa.bool_())


def _differ(page: str, other: str) -> Column:
    """Whether two pages are of different hosts or contents; one that is missing differs."""
    return ~F.struct(f"{page}._host", f"{page}._content").eqNullSafe(F.struct(f"{other}._host", f"{other}._content"))


def _next_unlike(sliced: DataFrame, side: str, order: list[Column], by_slice: Column) -> DataFrame:
    """``sliced`` with ``side``: the last row before each along ``order`` that is of another host or content."""
    spans = [Window.partitionBy("_slice").orderBy(*order), Window.orderBy(by_slice)]  # the second has one row a slice
    up_to = [span.rowsBetween(Window.unboundedPreceding, 0) for span in spans]
    within = sliced.withColumn("_prior", F.lag("_here").over(spans[0]))
    within = within.withColumn(
        side, F.last(F.when(_differ("_prior", "_here"), F.col("_prior")), ignorenulls=True).over(up_to[0])
    ).drop("_prior")
    # rows of a slice's first run look into the slices before, which may hold nothing but that run
    ends = (F.min_by, F.max_by) if side == "_before" else (F.max_by, F.min_by)
    edges = (
        within.groupBy("_slice")
        .agg(ends[0]("_here", "_place").alias("_first"), ends[1]("_here", "_place").alias("_end"), ends[1](side, "_place").alias("_unlike"))
        .withColumn("_prior", F.lag("_end").over(spans[1]))
        .withColumn("_breaks", _differ("_prior", "_first"))
        .withColumn("_unlike", F.coalesce("_unlike", F.when(F.col("_breaks"), F.col("_prior"))))
        .withColumn("_unlike", F.last("_unlike", ignorenulls=True).over(up_to[1]))
        .withColumn("_entry", F.when(F.col("_breaks"), F.col("_prior")).otherwise(F.lag("_unlike").over(spans[1])))
        .select("_slice", "_entry")
    )
    return within.join(F.broadcast(edges), "_slice").withColumn(side, F.coalesce(side, "_entry")).drop("_entry")


def partners(pages: DataFrame, content: str = "_key") -> DataFrame:
    """``_key, _partner`` for pages ``_host, _path, _key``: the nearest page by path on the host, of other content, if any."""
    order = ["_host", "_path", "_key"]
    sliced = session.stage(
        pages.select(*order, F.col(content).alias("_content"))
        .distinct()
        .repartitionByRange(*order)
        .withColumn("_slice", F.spark_partition_id()),
        "page-order",
    )
    near = sliced.withColumns({"_here": F.struct(*order, "_content"), "_place": F.struct(*order)})
    near = _next_unlike(near, "_before", [F.asc(c) for c in order], F.asc("_slice"))
    near = _next_unlike(near, "_after", [F.desc(c) for c in order], F.desc("_slice"))
    for side in ("_before", "_after"):
        same = F.col(f"{side}._host") == F.col("_host")
        near = near.withColumns(
            {f"{side}_path": F.when(same, F.col(f"{side}._path")), f"{side}_key": F.when(same, F.col(f"{side}._key"))}
        )
    earlier = F.arrow_udf(_earlier_nearer, "boolean")("_path", "_before_path", "_after_path")
    return near.select("_key", F.when(earlier, F.col("_before_key")).otherwise(F.col("_after_key")).alias("_partner"))


@shielded
def extract(pages: DataFrame, page: str = "html", url: str = "url", id_column: str = "page_id") -> DataFrame:
    """``pages`` with ``text``, ``n_chars`` and ``n_shared``, the number of lines its partner has too."""
    source = T.whole(page)
    pages = without(pages, *({"text", "n_chars", "n_shared"} - {page, url, id_column}))
    address = F.lower(T.whole(url))
    where = r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
    keyed = pages.withColumn("_key", F.xxhash64(id_column, url, source))
    narrow = session.stage(
        keyed.select(
            "_key",
            F.regexp_extract(address, where, 1).alias("_host"),
            F.regexp_extract(address, where, 2).alias("_path"),
            F.arrow_udf(_line_hashes, HASHED)(source).alias("_hashed"),
        ).select("_key", "_host", "_path", F.col("_hashed.lines").alias("_lines"), F.col("_hashed.content").alias("_content")),
        "page-lines",
    )
    # the lines are dealt out by page once, and read there as page and as partner
    lines = narrow.select("_key", "_lines").dropDuplicates(["_key"])
    other = lines.select(F.col("_key").alias("_partner"), F.col("_lines").alias("_partner_lines"))
    shared = (
        lines.join(partners(narrow, "_content"), "_key")
        .join(other, "_partner", "left")
        .select("_key", F.arrow_udf(_shared, "array<int>")("_lines", "_partner_lines").alias("_shared"))
    )
    # what the page itself settles is told before it moves, so only its wanted lines do
    left = F.array_except("_found.places", F.coalesce("_shared", F.array().cast("array<int>")))
    rest = F.array_join(F.transform(left, lambda place: F.get("_found.lines", place)), "\n")
    return (
        keyed.withColumn("_found", F.arrow_udf(_wanted, FOUND)(source))
        .join(shared, "_key", "left")
        .withColumn("text", F.coalesce("_found.text", rest))
        .withColumns({"n_chars": F.length("text").cast("long"), "n_shared": F.size("_shared").cast("long")})
        .drop("_key", "_shared", "_found")
    )
