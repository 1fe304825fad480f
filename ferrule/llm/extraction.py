"""HTML extraction by nearest-URL page differencing.

Each page becomes its text blocks in page order.  Pages are sorted by URL path within their host and
each is compared with its neighbours there: blocks on the longest common subsequence of two pages'
blocks belong to the site, not to the page, and are deleted, however much of the page they are.  Only blocks that
are not marked up as menus and the like are compared.  A page whose other blocks are equal to this one's, or edits of
them (three words in four the same, numbers apart), is a copy: it says nothing about the site, and the next
page that is none is compared instead.  Where one of two pages holds all blocks of the other, nothing tells
which of both cases it is; there the shared blocks are deleted only from a page of which they are at most half.  What the
page itself marks up decides the rest: blocks in menus, headers, footers, sidebars, notices, adverts,
forms and reader comments go; where there is an ``article`` (else a ``main``) element only its blocks stay,
and those are the page's own text even where another page quotes them.

All pages are range-partitioned by (host, path, URL, id), so a host with many pages is many tasks.  Copies
in a row count as one run, whose neighbours are the page before and the page after it.  A run at the edge of a
partition is finished in a second step, when the edges of the partitions before and after it are known, so the
result does not depend on where the partitions end.

Defined cases: null html is empty text; null urls have no neighbour; equal URLs are neighbours; repeated rows each have
their text; no pages, no rows; other columns, whatever their names, are not read; unclosed
elements end with their parent or the page, and an inline element's end tag ends the innermost open one of its name in the same block; a page without text has the empty string; a page with marked blocks only
is no neighbour.
"""

from __future__ import annotations

import math
import pickle
import re
import tempfile
import zlib
from bisect import bisect_right
from collections import Counter
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrule.llm.common import map_arrow, stored

#: Pages of one range partition, about; with more than ``RANGES`` partitions' worth of pages they grow.
GROUP = 64
RANGES = 4096
#: Bytes of a run of pages that a task holds in memory before it puts them in a temporary file.
HELD = 1 << 22

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp "
                    "small span strike strong sub sup time tt u var wbr".split())
_DROP = frozenset("script style noscript template head title nav footer aside form button select textarea option iframe object svg "
                  "canvas audio video dialog menu".split())
_ROLE = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar alertdialog form".split())
#: Words of a class or id that mark site text, and words that may stand beside them in one name.
_HINTS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo cookie cookies consent notice alert popup modal "
                   "sidebar side menu nav navbar navigation breadcrumb breadcrumbs toolbar header masthead footer comment comments disqus replies "
                   "share sharing social related recommended newsletter subscribe login signup search pagination pager skip".split())
_FRAME = frozenset("area bar bottom box btn button buttons center col column container content float form global group inner item items left link "
                   "links list main middle outer page panel placeholder popular post posts primary reader readers right row secondary section site "
                   "slot stories sub text thread to top unit user users widget widgets wrap wrapper x".split())
_SELF_CLOSING_PARENT = {"p": frozenset({"p"}), "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
                        "tr": frozenset({"tr", "td", "th"}), "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}),
                        "option": frozenset({"option"})}
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_NAME_WORDS = re.compile(r"[a-z]+")

#: Where a block stands: in boilerplate, in the page's article, in its main part, elsewhere.
BOILERPLATE, ARTICLE, MAIN, ELSEWHERE = 0, 1, 2, 3


@lru_cache(4096)
def _marks(names: str) -> bool:
    """Whether one of these classes names site text as a whole: ``side-bar-left`` does, ``side-effects`` does not."""
    for name in names.lower().split():
        words = _NAME_WORDS.findall(name)
        if not _HINTS.isdisjoint(words) and all(w in _HINTS or w in _FRAME for w in words):
            return True
    return False


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, bool]] = []    # tag, in boilerplate, place, inline and only text
        self.tags: dict[str, int] = {}                       # how many are open
        self.blocks: list[tuple[str, int]] = []
        self.now: list[str] = []

    def _state(self) -> tuple[bool, int]:
        return self.open[-1][1:3] if self.open else (False, ELSEWHERE)

    def _cut(self, start: int):
        for o in self.open[start:]:
            self.tags[o[0]] -= 1
        del self.open[start:]

    def _push(self, tag: str, drop: bool, place: int, plain: bool = False):
        self.open.append((tag, drop, place, plain))
        self.tags[tag] = self.tags.get(tag, 0) + 1

    def _end_block(self):
        if self.now:
            text = _SPACE.sub(" ", "".join(self.now)).strip()
            if text:
                drop, place = self._state()
                self.blocks.append((text, BOILERPLATE if drop else place))
            self.now = []

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            if tag == "br":
                self.now.append(" ")
            elif tag not in _INLINE:
                self._end_block()
            return
        hinted = bool(attrs) and self._hinted(attrs)
        if tag in _INLINE and not hinted:
            drop, place = self._state()
            self._push(tag, drop, place, True)
            return
        self._end_block()
        close = _SELF_CLOSING_PARENT.get(tag)
        if close and any(self.tags.get(t) for t in close):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in close:
                    self._cut(i)
                    break
                if self.open[i][0] in ("ul", "ol", "dl", "table", "div", "article", "section", "body", "blockquote"):
                    break
        drop, place = self._state()
        role = next((v or "" for k, v in attrs if k == "role"), "").lower() if attrs else ""
        if tag == "article":
            place = ARTICLE
        elif (tag == "main" or role == "main") and place != ARTICLE:
            place = MAIN
        drop = drop or tag in _DROP or (tag == "header" and place != ARTICLE) or role in _ROLE or (
            hinted and tag not in ("body", "html", "article", "main"))
        self._push(tag, drop, place)

    @staticmethod
    def _hinted(attrs) -> bool:
        return any(k in ("class", "id") and v and _marks(v) or k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)

    def handle_endtag(self, tag):
        inline = tag in _INLINE
        if self.tags.get(tag):
            for i in range(len(self.open) - 1, -1, -1):
                name, _, _, plain = self.open[i]
                if name == tag:
                    if plain:                                # what opened inside it stays open
                        self.tags[tag] -= 1
                        del self.open[i]
                    else:
                        self._end_block()
                        self._cut(i)
                    return
                if inline and name not in _INLINE and name not in _SELF_CLOSING_PARENT:
                    break                                    # an inline element ends inside its block
        if not inline:
            self._end_block()

    def handle_data(self, data):
        if not (self.open and self.open[-1][0] in ("script", "style")):
            self.now.append(data)


def blocks(html: str | None) -> list[tuple[str, int]]:
    """(text, place) of every text block of the page, in page order."""
    if not html:
        return []
    p = _Blocks()
    p.feed(html)
    p.close()
    p._end_block()
    return p.blocks


def _common(a: list[str], b: list[str]) -> set[int]:
    """Indices of a on a longest common subsequence with b; of several, that which matches the earliest lines.

    Row j tells for every i whether a[i:] has a longer common subsequence with b[j:] than a[i + 1:] has: one bit each,
    kept in one integer, bit 0 for the last i (a clear bit: longer).  Every ``step``-th row is kept, and the rows between two
    of them are made again on the way back; the places of a line are one such integer, kept if there are over sqrt(len(a)).
    That makes some 3 * sqrt(n) integers of n bits for n lines.
    """
    both = set(a) & set(b)
    ia, b = [i for i, x in enumerate(a) if x in both], [x for x in b if x in both]
    n, m = len(ia), len(b)
    full = (1 << n) - 1
    places: dict[str, list[int]] = {}
    for i, k in enumerate(ia):
        places.setdefault(a[k], []).append(n - 1 - i)

    def as_bits(at: list[int]) -> int:
        if len(at) == 1:
            return 1 << at[0]
        bits = bytearray(at[0] // 8 + 1)
        for p in at:
            bits[p >> 3] |= 1 << (p & 7)
        return int.from_bytes(bits, "little")
    often = {x: as_bits(at) for x, at in places.items() if len(at) ** 2 > n}

    def above(row: int, j: int) -> int:
        """Row j of row j + 1."""
        x = b[j]
        hit = row & (often[x] if x in often else as_bits(places[x]))
        return ((row + hit) | (row - hit)) & full

    step = math.isqrt(m) + 1
    kept, row = {m: full}, full
    for j in range(m - 1, 0, -1):
        row = above(row, j)
        if j % step == 0:
            kept[j] = row
    out, i, j, rows, low = set(), 0, 0, [], 0
    while i < n and j < m:
        if a[ia[i]] == b[j]:
            out.add(ia[i])
            i, j = i + 1, j + 1
            continue
        if not low <= j < low + len(rows):
            high = min(m, (j // step + 1) * step)
            rows = [kept[high]]
            for k in range(high - 1, j - 1, -1):
                rows.append(above(rows[-1], k))
            rows.reverse()
            low = j
        if rows[j - low] >> (n - 1 - i) & 1:
            i += 1
        else:
            j += 1
    return out


def _own(page: list[tuple[str, int]]) -> list[int]:
    """Indices of the blocks that are not marked as boilerplate."""
    return [i for i, (_, p) in enumerate(page) if p != BOILERPLATE]


def _shared(page: list[tuple[str, int]], other: list[tuple[str, int]]) -> tuple[set[int], list[str], list[str]]:
    """Indices of the page's unmarked blocks that both have, and the texts of those that only one of both has."""
    own, theirs = _own(page), [other[i][0] for i in _own(other)]
    shared = {own[k] for k in _common([page[i][0] for i in own], theirs)}
    left = Counter(theirs)
    left.subtract(page[i][0] for i in shared)
    return shared, [page[i][0] for i in own if i not in shared], list(left.elements())


def _edited(a: list[str], b: list[str]) -> bool:
    """Whether two pages that differ in these blocks are copies of one another."""
    if not a and not b:
        return True
    x, y = (Counter(_DIGITS.sub("0", " ".join(t)).split()) for t in (a, b))
    return bool(a and b) and (x & y).total() * 4 >= max(x.total(), y.total()) * 3


def _site(page: list[tuple[str, int]], other: list[tuple[str, int]]) -> set[int]:
    """Indices of the page's blocks that the nearest page shows to be the site's."""
    shared, rest, others = _shared(page, other)
    if _edited(rest, others):
        return set()
    if (not rest or not others) and sum(len(page[i][0]) for i in shared) * 2 > sum(len(page[i][0]) for i in _own(page)):
        return set()
    return shared


def _same(page: list[tuple[str, int]], other: list[tuple[str, int]]) -> bool:
    """Whether the pages are equal or near-equal."""
    return page == other or _edited(*_shared(page, other)[1:])


def _text(page: list[tuple[str, int]], site: set[int]) -> str:
    stay = next((p for p in (ARTICLE, MAIN) if any(x == p for _, x in page)), ELSEWHERE)
    return "\n".join(t for i, (t, p) in enumerate(page) if p == stay and (p == ARTICLE or i not in site))


def main_text(page: list[tuple[str, int]], others: list[list[tuple[str, int]]]) -> str:
    """The page's own text, given the pages that are nearest by URL."""
    return _text(page, set().union(*(_site(page, o) for o in others)))


def _key(site, path, url, page_id, tie) -> tuple:
    """Sorts as Spark sorts these columns."""
    return site, path, url, page_id is not None, page_id or 0, tie


def _bounds(src: DataFrame) -> list[tuple]:
    """Keys that part the pages with a URL into ranges of about equal numbers of rows."""
    keys = src.filter("url is not null").select("site", "path", "url", "page_id", "tie")
    n = keys.count()
    parts = min(RANGES, -(-n // GROUP))
    if parts < 2:
        return []
    # a sample by hash: the same rows in every run
    share = min(1 << 30, -(-(16 * parts << 30) // n))
    sample = sorted(_key(*r) for r in keys.filter(F.pmod(F.xxhash64("url", "page_id", "tie"), F.lit(1 << 30)) < share).collect())
    return [sample[k * len(sample) // parts] for k in range(1, parts)] if sample else []


def _contexts(edges: list[tuple]) -> dict[int, tuple]:
    """part: (the page before its first run, the page after its last one), from
    (part, site, page) of the first, the second run's first, the last run's predecessor and the last page of each part."""
    edges = sorted(edges, key=lambda e: e[0])
    out: dict[int, list] = {e[0]: [None, None] for e in edges}
    for order, side, near, inner, far in ((edges, 0, 1, 3, 4), (edges[::-1], 1, 4, 2, 1)):
        for before, e in zip(order, order[1:]):
            if before[far][0] != e[near][0]:
                continue                                       # another host
            if not _same(before[far][1], e[near][1]):
                out[e[0]][side] = before[far][1]
            elif before[inner] is None:
                out[e[0]][side] = out[before[0]][side]         # all of that part is the same run
            elif before[inner][0] == e[near][0]:
                out[e[0]][side] = before[inner][1]
    return {k: tuple(v) for k, v in out.items()}


def extract(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    def parse(b):
        for a in range(0, b.num_rows, 512):
            s = b.slice(a, 512)
            # marked blocks are neither compared nor kept
            found = [zlib.compress(pickle.dumps([x for x in blocks(h) if x[1] != BOILERPLATE])) for h in s.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), pa.array(found, pa.binary())], ["page_id", "url", "page"])

    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    host = F.lower(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_extract("url", r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1)
    src = src.select("page_id", "url", "html", F.coalesce(host, F.lit("")).alias("site"), F.coalesce(path, F.lit("")).alias("path"),
                     F.xxhash64("html").alias("tie"))
    bounds = spark.sparkContext.broadcast(_bounds(src))

    def dealt(b):
        keys = [b.column(k).to_pylist() for k in range(5)]
        # null urls are no neighbours of anything: parts below 0
        part = pa.array([-1 - ((r[3] or 0) ^ r[4]) % (1 << 30) if r[2] is None else bisect_right(bounds.value, _key(*r)) for r in zip(*keys)], pa.int64())
        at = 0
        for x in parse(pa.RecordBatch.from_arrays([b.column(3), b.column(2), b.column(5)], ["page_id", "url", "html"])):
            n = x.num_rows
            yield pa.RecordBatch.from_arrays([part.slice(at, n), *(b.column(k).slice(at, n) for k in (0, 1, 4)), *x.columns],
                                             ["part", "site", "path", "tie", "page_id", "url", "page"])
            at += n

    near = map_arrow(src.select("site", "path", "url", "page_id", "tie", "html"), dealt,
                     "part long, site string, path string, tie long, page_id long, url string, page binary")
    near = near.repartition("part").sortWithinPartitions("part", "site", "path", "url", "page_id", "tie")

    def compare(batches):
        """Rows with the text; rows with the pickled page where a neighbour is in another part; and the edges of each part."""
        out: list[tuple] = []
        run: list = []                                         # site, last page, page before the run (None: none), left is open
        held = None                                            # the pages of the run: (page, ids and urls), one by one
        part = first = second = before = None

        def close(after, right_open):
            held.seek(0)
            for _ in range(run[4]):
                page, members = pickle.load(held)
                site = set().union(*(_site(page, o) for o in (run[2], after) if o is not None))
                state = None
                if run[3] or right_open:
                    state = zlib.compress(pickle.dumps((page, site, run[3], right_open)), 1)
                text = None if state else _text(page, site)
                for pid, url in members:
                    out.append((part, pid, url, text, state))
                    if len(out) >= 256:
                        yield batch()
            held.seek(0)
            held.truncate()

        def keep(page, members):
            pickle.dump((page, members), held)
            run[4] += 1

        def end_part():
            keep(now[0], now[1])
            yield from close(None, True)
            edge = part, first, second, before, (run[0], run[1])
            out.append((part, None, None, None, b"E" + zlib.compress(pickle.dumps(edge), 1)))

        def batch():
            kinds = pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()
            rows = pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)],
                                              ["part", "page_id", "url", "text", "state"])
            out.clear()
            return rows

        now = None                                             # the last page and its members
        with tempfile.SpooledTemporaryFile(max_size=HELD) as held:
            for b in batches:
                for p, site, pid, url, packed in zip(*(b.column(k).to_pylist() for k in range(5))):
                    page = pickle.loads(zlib.decompress(packed))
                    if url is None or not _own(page):
                        out.append((p, pid, url, _text(page, set()), None))
                        continue
                    if part is not None and p != part:
                        yield from end_part()
                        part = None
                    if part is None:
                        part, first, second, before = p, (site, page), None, None
                        run, now = [site, page, None, True, 0], (page, [(pid, url)])
                    elif site == run[0] and page == now[0]:
                        now[1].append((pid, url))
                    else:
                        keep(*now)
                        now = page, [(pid, url)]
                        if site == run[0] and _same(run[1], page):
                            run[1] = page
                        else:
                            yield from close(page if site == run[0] else None, False)
                            second = second or (site, page)
                            before = run[0], run[1]
                            run = [site, page, run[1] if site == run[0] else None, False, 0]
                    if len(out) >= 256:
                        yield batch()
            if part is not None:
                yield from end_part()
            if out:
                yield batch()

    found = stored(spark, near.select("part", "site", "page_id", "url", "page").mapInArrow(
        compare, "part long, page_id long, url string, text string, state binary"), "pages", compression="zstd")
    is_edge = F.coalesce(F.substring("state", 1, 1) == F.lit(b"E"), F.lit(False))
    edges = [pickle.loads(zlib.decompress(r.state[1:])) for r in found.filter(is_edge).select("state").toLocalIterator()]
    contexts = spark.sparkContext.broadcast(_contexts(edges))

    def finish(b):
        texts = []
        for part, text, state in zip(*(b.column(k).to_pylist() for k in (0, 3, 4))):
            if state is not None:
                page, site, *sides = pickle.loads(zlib.decompress(state))
                for o, is_open in zip(contexts.value[part], sides):
                    if is_open and o is not None:
                        site |= _site(page, o)
                text = _text(page, site)
            texts.append(text)
        yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(texts, pa.string())], ["page_id", "url", "text"])
    return map_arrow(found.filter(~is_edge), finish, "page_id long, url string, text string").select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
