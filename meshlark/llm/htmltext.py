"""Main text of web pages by differencing each page with the one of the nearest URL on its host.

Pages are cut into blocks with a zone each. Within a host, pages are put in order of their URL path and
aligned with a neighbour by longest common subsequence of lines; lines that both have are template and
go, in plain markup and in elements that only their names make look like the article. Lines inside a
marked-up article are the page's own even where a copy of the article lies next
door, so they are exempt; lines in elements whose markup names them as menus, footers, adverts and so
on go in any case, as such text differs from page to page.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape
from itertools import accumulate, chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._work import col, materialise, squeeze, tidy, unsqueeze

#: Element names by kind.
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noframes".split())
DROPPED = frozenset("nav footer aside form script style noscript template iframe svg math button select textarea head title menu dialog object canvas audio video map".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
#: Words in class, id and role that name an element as something other than the article.
NOISE = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies copyright dialog disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted recommended related reply replies search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget widgets".split())
NOTES = frozenset("comment comments reply replies".split())
#: Words that mark an element as one that may be the article.
STORY = frozenset("article story post entry content main".split())
#: Open elements that a start tag ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

OUT, BODY, MAIN, GUESS = 0, 1, 2, 3
#: Bits at most that an alignment holds at once: how work is cut, not what it gives.
ROW_BITS = 1 << 31
_TAG = re.compile(r"<!--(?:.*?-->|.*\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']+|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"(?i)\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def _traits(tag: str, attrs: str, in_main: bool) -> tuple[bool, int]:
    """Whether an element is left out, and its zone: MAIN is the article, GUESS may be by its names."""
    out, main, words = tag in DROPPED or tag == "header" and not in_main, tag in ("article", "main"), set()
    if attrs:
        for name, *values in _ATTR.findall(attrs):
            v = "".join(values).lower()
            name = name.lower()
            if name in ("class", "id", "role"):
                words.update(re.split(r"[^a-z0-9]+", v))
            elif name == "style":
                out |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v))
            else:
                out |= name == "hidden" or v == "true"
    if tag in ("html", "body", "main"):
        return False, MAIN if main else BODY
    noisy = words & (NOTES if tag == "article" else NOISE)
    if in_main and tag != "article":
        noisy -= {"header", "content"}
    return out or bool(noisy), MAIN if main else GUESS if not noisy and words & STORY else BODY


def blocks(html: str | None) -> list[tuple[int, str]]:
    """(zone, text) of each block with text, in page order: MAIN in the article, GUESS in what names make look like it, BODY in plain markup, OUT elsewhere."""
    html = html or ""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int, bool]] = []  # element, zone, whether inline
    is_open: Counter[str] = Counter()
    parts: list[str] = []
    zone, at = BODY, 0

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append((zone, text))

    def pop_to(k: int) -> None:
        nonlocal zone
        while len(stack) > k:
            is_open[stack.pop()[0]] -= 1
        zone = stack[-1][1] if stack else BODY

    def add(piece: str) -> None:
        if piece:
            parts.append(unescape(piece) if "&" in piece else piece)

    while at < len(html):
        m = _TAG.search(html, at)
        if not m:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:-3])
            continue
        block = tag in BLOCKS
        if block or tag in DROPPED:
            flush()
        if m[1]:
            if is_open[tag] > 0:
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                if any(not inline for *_, inline in stack[k:]):
                    flush()
                pop_to(k)
            continue
        if block:
            ends = ENDS.get(tag, set()) | ({"p"} if tag not in ("br", "html", "body", "head") else set())
            if any(is_open[e] for e in ends):
                k = len(stack) - 1
                while k >= 0 and stack[k][0] not in ends and (stack[k][2] or tag in ENDS and stack[k][0] == "p"):
                    k -= 1
                if k >= 0 and stack[k][0] in ends:
                    pop_to(k)
        if tag in VOID or m[3].endswith("/") and not block:
            continue
        left_out, kind = _traits(tag, m[3], zone in (MAIN, GUESS))
        here = OUT if left_out or zone == OUT else MAIN if MAIN in (kind, zone) else GUESS if GUESS in (kind, zone) else BODY
        if here != zone:
            flush()
        if tag in RAW:
            end = re.compile(rf"</{tag}\b", re.I).search(html, at)
            at = end.start() if end else len(html)
        stack.append((tag, here, tag in INLINE))
        is_open[tag] += 1
        zone = here
    flush()
    return out


def _rows(a: list[str], b: list[str], keep: bool) -> list[int]:
    """Rows of the lengths' table, all or the last only: a bit of b is 0 where the length grows."""
    where: dict[str, int] = {}
    for k, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << k
    v = full = (1 << len(b)) - 1
    rows = [full]
    for x in a:
        u = v & where.get(x, 0)
        v = (v + u | v - u) & full
        if keep:
            rows.append(v)
    return rows if keep else [v]


def _lengths(a: list[str], b: list[str]) -> list[int]:
    """Lengths of longest common subsequences of a and each beginning of b."""
    v = _rows(a, b, False)[0]
    return list(accumulate((bit == "0" for bit in reversed(f"{v:0{len(b)}b}")), initial=0)) if b else [0]


def _aligned(a: list[str], b: list[str]) -> list[int]:
    """Positions in a of a longest common subsequence. Where all rows would take over ROW_BITS, a is halved and b cut
    where the halves' lengths add up to most (Hirschberg), so that space is linear."""
    if not a or not b:
        return []
    if len(a) * len(b) > ROW_BITS and len(a) > 1:
        half = len(a) // 2
        left, right = _lengths(a[:half], b), _lengths(a[:half - 1:-1], b[::-1])
        cut = max(range(len(b) + 1), key=lambda j: left[j] + right[len(b) - j])
        return [*_aligned(a[:half], b[:cut]), *(half + k for k in _aligned(a[half:], b[cut:]))]
    rows = _rows(a, b, True)
    found, i, j = [], len(a), len(b)
    while i and j:
        if rows[i] >> j - 1 & 1:
            j -= 1
        elif rows[i - 1] >> j - 1 & 1:
            found.append(i - 1)
            i, j = i - 1, j - 1
        else:
            i -= 1
    return found[::-1]


def common(a: list[str], b: list[str]) -> list[int]:
    """Positions in a of a longest common subsequence of a and b.

    Bit-parallel over the lines that both have, once common ends are set aside.
    """
    lo, hi = 0, min(len(a), len(b))
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    tail = 0
    while tail < hi - lo and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    mid_a, mid_b = range(lo, len(a) - tail), range(lo, len(b) - tail)
    both = set(a[lo : len(a) - tail]) & set(b[lo : len(b) - tail])
    ia, jb = [i for i in mid_a if a[i] in both], [j for j in mid_b if b[j] in both]
    found = _aligned([a[i] for i in ia], [b[j] for j in jb])
    return [*range(lo), *(ia[k] for k in found), *range(len(a) - tail, len(a))]


def main_text(page: list[tuple[int, str]], neighbour: list[tuple[int, str]] | None) -> str:
    """The page's own lines, one to a line.

    Lines shared with the neighbour go unless they lie in the article. Of a copy, a page with the same lines, sharing
    says nothing: it takes nothing away.
    """
    if neighbour is not None and _plain(neighbour) == _plain(page):
        neighbour = None
    shared = set(common([t for _, t in page], [t for _, t in neighbour])) if neighbour else set()
    return "\n".join(t for k, (z, t) in enumerate(page) if z == MAIN or z != OUT and k not in shared)


def _shared_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _plain(page: list[tuple[int, str]]) -> list[str]:
    """The lines by which a page is a copy of another."""
    return [t for z, t in page if z != OUT]


def _digest(page: list[tuple[int, str]]) -> bytes:
    return blake2b("\n".join(_plain(page)).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _packed(page: list[tuple[int, str]]) -> bytes:
    return squeeze(pickle.dumps(page, 5))


def _page(data: bytes) -> list[tuple[int, str]]:
    return pickle.loads(unsqueeze(data))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, url, host, path, h, n, html) with the page's blocks in place of its html."""
    for b in batches:
        for k in range(0, b.num_rows, 512):
            part = b.slice(k, 512)
            yield pa.RecordBatch.from_arrays([*part.columns[:6], pa.array([_packed(blocks(x)) for x in part.column(6).to_pylist()], pa.binary())], names=["id", "url", "host", "path", "h", "n", "page"])


#: What a range gives: texts of its own pages; pages of its first and last run, which need what lies beyond its ends; the
#: pages at its ends that other ranges may need; and a row that says what its ends are.
_OUT = "kind string, part int, id long, url string, path string, page binary, text string, state binary"


def _rows_out(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["kind", "part", "id", "url", "path", "page", "text", "state"])


def _own_text(path: str, page: list, before: tuple | None, after: tuple | None) -> str:
    """The page's text by the nearer of two neighbours (path, page)."""
    near = max((p for p in (before, after) if p), key=lambda p: _shared_start(p[0], path), default=None)
    return main_text(page, near[1] if near else None)


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, url, host, path, page) in order of host and path. Copies that follow each other are one run, of which the
    lines are held once; a page's neighbour is the nearer of the pages next to its run."""
    part = TaskContext.get().partitionId()

    def runs():
        members, last, where = [], None, None
        for b in batches:
            for i, u, host, path, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                page = _page(data)
                if members and (where != host or _plain(page) != last):
                    yield where, members
                    members = []
                if members and page == members[-1][3]:
                    page = members[-1][3]
                where, last = host, _plain(page)
                members.append((i, u, path, page))
        if members:
            yield where, members

    def end(kind: str, member: tuple) -> tuple:
        return kind, part, member[0], member[1], member[2], _packed(member[3]), None, None

    def rows():
        first = prev = cur = None
        beside = {}  # whether the pages next to the first and the last run are on the same host
        for nxt in chain(runs(), [None]):
            if cur is not None:
                before = prev[1][-1] if prev and prev[0] == cur[0] else None
                after = nxt[1][0] if nxt and nxt[0] == cur[0] else None
                kind = ("only" if nxt is None else "first") if prev is None else "last" if nxt is None else None
                if prev is None:
                    first = cur[0], _digest(cur[1][0][3])
                    yield end("F", cur[1][0])
                    if after:
                        beside["A"] = True
                        yield end("A", after)
                if nxt is None:
                    yield end("L", cur[1][-1])
                    if before:
                        beside["B"] = True
                        yield end("B", before)
                    state = (part, *first, cur[0], _digest(cur[1][-1][3]), prev is None, beside)
                    yield "state", part, None, None, None, None, None, pickle.dumps(state)
                near = [(p[2], p[3]) if p else None for p in (before, after)]
                for m in cur[1]:
                    yield end(kind, m) if kind else ("text", part, m[0], m[1], None, None, _own_text(m[2], m[3], *near), None)
            prev, cur = cur, nxt

    held, size = [], 0
    for r in rows():
        held.append(r)
        size += len(r[5] or r[6] or "")
        if size > 4 << 20 or len(held) >= 4096:
            yield _rows_out(held)
            held, size = [], 0
    if held:
        yield _rows_out(held)


def _beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (state), one to a range: where the page before and the page after each range's first and last run is."""
    states = sorted(pickle.loads(x) for b in batches for x in b.column(0).to_pylist())
    if not states:
        return
    before: list[tuple | None] = [None]
    for (q, host, digest, host_2, digest_2, only, beside), nxt in zip(states, states[1:], strict=False):
        if host_2 != nxt[1]:
            before.append(None)
        elif digest_2 != nxt[2]:
            before.append((q, "L"))
        else:  # the run goes on
            before.append(before[-1] if only else (q, "B") if "B" in beside else None)
    after: list[tuple | None] = [None]
    for (q, host, digest, host_2, digest_2, only, beside), prev in zip(states[::-1], states[-2::-1], strict=False):
        if host != prev[3]:
            after.append(None)
        elif digest != prev[4]:
            after.append((q, "F"))
        else:
            after.append(after[-1] if only else (q, "A") if "A" in beside else None)
    out = []
    for s, b, a in zip(states, before, after[::-1], strict=True):
        if s[5]:
            out.append((s[0], "only", b, a))
        else:
            out += [(s[0], "first", b, (s[0], "A") if "A" in s[6] else None), (s[0], "last", (s[0], "B") if "B" in s[6] else None, a)]
    flat = [(p, k, *(b or (None, None)), *(a or (None, None))) for p, k, b, a in out]
    kinds = (pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat, strict=True), kinds, strict=True)], names=["part", "kind", "b_part", "b_kind", "a_part", "a_kind"])


def _open_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, url, path, page, path and page before, path and page after): texts of pages at the ends of ranges."""
    for b in batches:
        for k in range(0, b.num_rows, 512):
            i, u, *cols = (c.to_pylist() for c in b.slice(k, 512).columns)
            texts = []
            for path, page, b_path, b_page, a_path, a_page in zip(*cols, strict=True):
                near = [(x, _page(y)) if y is not None else None for x, y in ((b_path, b_page), (a_path, a_page))]
                texts.append(_own_text(path, _page(page), *near))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(u, pa.string()), pa.array(texts, pa.string())], names=["id", "url", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", group_rows: int | None = None) -> DataFrame:
    """One row per page: id (long), url, text and n_chars. Ids are integers or null; others stop the job at Spark's cast.

    A null or empty html gives an empty text; pages without a URL are one host with one path; repeated rows each
    get a row and count as copies of each other; other columns are not read. Pages are dealt by ranges of host, path, id
    and content (as many as the session shuffles to, or of about ``group_rows`` pages), so that no host, however large,
    meets in one task. What lies beyond a range's ends is joined to the pages that need it; texts do not depend on where
    ranges end.
    """
    src = pages.select(col(id_col).cast("long").alias("id"), col(url_col).cast("string").alias("url"), col(html_col).cast("string").alias("html"))
    rest = F.regexp_replace(F.coalesce("url", F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://|^//", "")
    host = F.lower(F.regexp_extract(rest, "^(?:[^/]*@)?([^/]*)", 1))
    path = F.concat(F.lit("/"), F.regexp_extract(rest, "^[^/]*/([^?#]*)", 1))
    n = F.monotonically_increasing_id().alias("n")  # rows that are alike in all else need not be in one range
    src = src.select("id", "url", host.alias("host"), path.alias("path"), F.xxhash64("html").alias("h"), n, "html")
    cut = src.mapInArrow(tidy(_blocks), "id long, url string, host string, path string, h long, n long, page binary")
    order = ["host", "path", "id", "h", "n"]
    dealt = cut.repartitionByRange(*order) if group_rows is None else cut.repartitionByRange(max(1, -(-pages.count() // group_rows)), *order)
    found = dealt.sortWithinPartitions(*order).select("id", "url", "host", "path", "page").mapInArrow(tidy(_difference), _OUT)
    found, _ = materialise(found, "page-texts", "zstd")  # most of it texts

    # A row to each range: so few that one task looks through them. Pages come by joins.
    beyond = found.where("kind = 'state'").select("state").repartition(1).mapInArrow(tidy(_beyond), "part int, kind string, b_part int, b_kind string, a_part int, a_kind string")
    ends = found.where(F.col("kind").isin("F", "L", "A", "B")).select("part", "kind", "path", "page")
    for side in "ba":
        named = ends.select(F.col("part").alias(f"{side}_part"), F.col("kind").alias(f"{side}_kind"), F.col("path").alias(f"{side}_path"), F.col("page").alias(f"{side}_page"))
        beyond = beyond.join(named, [f"{side}_part", f"{side}_kind"], "left")
    beyond, _ = materialise(beyond.select("part", "kind", "b_path", "b_page", "a_path", "a_page"), "page-neighbours")
    opened = found.where(F.col("kind").isin("first", "last", "only")).select("part", "kind", "id", "url", "path", "page")
    opened = opened.join(beyond, ["part", "kind"]).select("id", "url", "path", "page", "b_path", "b_page", "a_path", "a_page")
    out = found.where("kind = 'text'").select("id", "url", "text").unionByName(opened.mapInArrow(tidy(_open_texts), "id long, url string, text string"))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
