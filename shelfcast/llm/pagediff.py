"""Main text of web pages by nearest-URL page differencing.

A page becomes text lines, one per block element, each with its zone: ``main``
(inside an article or main element), ``noise`` (inside navigation, footers,
sidebars, forms, adverts, comment threads and the like, told by element, role
or class) or ``open``.  Spark orders pages by host and URL path; of the two
neighbours the one with the longer common path is the page's pair.  Lines are
aligned by longest common subsequence and shared lines outside ``main`` are
deleted as the site's furniture; what is left of ``noise`` goes by its markup.
Lines outside ``main`` that the pair lacks and no markup names stay.

Shared lines inside ``main`` stay: copies of an article on one host share all
of it, and so would lose it.  On a page without a main element a shared line
goes only by evidence on the line itself: Spark counts the host's distinct pages
that hold it, pages with equal text outside the named furniture once, and it
must be ``HOLDERS`` of them, or two that are at least half of the host's.

Edge cases: null html is an empty page, which is nobody's pair; a null URL, or a host with one page,
has no pair and loses only noise; unclosed and badly nested elements end at the
next article, main or end of the body; several rows of one URL are neighbours;
identical rows are copies; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import common as C
from shelfcast.llm.ordered import AFTER, OWN, with_neighbours

MAIN, OPEN, NOISE = "main", "open", "noise"
HOLDERS = 3

# fixed values: HTML element names and the class, id and role words that mark page furniture
RAW = "script style noscript template iframe object svg math canvas textarea select title".split()
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE_ELEMENTS = frozenset("nav footer aside form menu dialog button fieldset head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
NOISE_WORDS = frozenset("""ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies
consent disqus footer menu nav navbar navigation newsletter notice notices pagination popup promo promotion related replies share sharing
sidebar signup social sponsor sponsored subscribe toolbar widget""".split())
# words that only say how something is laid out
LAYOUT_WORDS = frozenset("area bar block body box buttons container content inner item items link links list main row section slot unit wrap wrapper".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*)>|<[!?][^>]*(?:>|\Z)",
    re.S | re.I)
# a tag that the end of the page cuts off; a bare "<" is text
_UNFINISHED = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


def _furniture(name: str, attrs: str, in_main: bool) -> bool:
    if name in NOISE_ELEMENTS or name == "header" and not in_main:
        return True
    if not attrs:
        return False
    for key, *values in _ATTR.findall(attrs):
        value, key = "".join(values).lower(), key.lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "role" and value in NOISE_ROLES:
            return True
        if key in ("class", "id") and name not in ("article", "main", "body", "html") and any(_names_furniture(c, in_main) for c in value.split()):
            return True
    return False


def _names_furniture(token: str, in_main: bool) -> bool:
    """Does a class or id name page furniture?  In an article all its words must: ``comment-list`` does, ``share-price`` does not."""
    words = {w for w in re.split(r"[_-]+", token) if w}
    return bool(NOISE_WORDS & words) and (not in_main or words <= NOISE_WORDS | LAYOUT_WORDS)


def page_lines(html: str | None) -> list[tuple[str, str]]:
    """(line, zone) per block of text, in page order."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    at, main, noise_name, noise_depth = 0, 0, "", 0
    html = html or ""

    def flush() -> None:
        line = " ".join(unescape("".join(held)).split())
        held.clear()
        if line:
            out.append((line, NOISE if noise_name else MAIN if main else OPEN))

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            held.append(html[at:m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name, closing = name.lower(), bool(m["end"])
        block = name in BLOCKS
        if block:
            flush()
        elif name == "br":
            held.append(" ")
        if noise_name and (name in ("article", "main") and not closing and noise_name not in ("article", "main") or name == "body" and closing):
            noise_name, noise_depth = "", 0
        if noise_name:
            if name == noise_name and name not in VOID:
                noise_depth += -1 if closing else 1
                if not noise_depth:
                    if not block:
                        flush()
                    noise_name = ""
            continue
        if name in ("article", "main"):
            main = max(0, main + (-1 if closing else 1))
        if not closing and name not in VOID and not m["attrs"].endswith("/") and _furniture(name, m["attrs"], main > 0):
            if not block:
                flush()
            noise_name, noise_depth = name, 1
    if at < len(html):
        held.append(_UNFINISHED.sub("", html[at:]))
    flush()
    return out


def common_lines(a: list[str], b: list[str]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    where = defaultdict(list)
    for j, line in enumerate(b):
        where[line].append(j)
    ends, links, last = [], [], []  # ends[k]: smallest place in b at which k + 1 lines match; last[k]: its link
    for i, line in enumerate(a):
        for j in reversed(where.get(line, ())):
            k = bisect_left(ends, j)
            links.append((i, last[k - 1] if k else -1))
            if k == len(ends):
                ends.append(j)
                last.append(len(links) - 1)
            else:
                ends[k], last[k] = j, len(links) - 1
    out, at = [], last[-1] if last else -1
    while at >= 0:
        i, at = links[at]
        out.append(i)
    return out[::-1]


def line_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def shared_lines(lines: list[tuple[str, str]], pair: list[tuple[str, str]] | None) -> set[int]:
    return set(common_lines([t for t, _ in lines], [t for t, _ in pair])) if pair else set()


def main_text(lines: list[tuple[str, str]], shared: set[int]) -> tuple[str, int, int]:
    """(text, lines deleted as shared, lines deleted by markup)."""
    kept, n_shared, n_markup = [], 0, 0
    for i, (text, zone) in enumerate(lines):
        if zone == MAIN:
            kept.append(text)
        elif i in shared:
            n_shared += 1
        elif zone == NOISE:
            n_markup += 1
        else:
            kept.append(text)
    return "\n\n".join(kept), n_shared, n_markup


def _common_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


TEXTS = "page_id long, url string, text string, n_chars long, n_shared long, n_markup long"
# host and look (hash of the lines that are not noise); lines are set where shared open lines await evidence
ALIGNED = TEXTS + ", host string, look long, lines array<struct<line: string, zone: string, shared: boolean>>"
_LINES = pa.list_(pa.struct([("line", pa.string()), ("zone", pa.string()), ("shared", pa.bool_())]))


def look_hash(lines: list[tuple[str, str]]) -> int:
    return line_hash("\n".join(z[0] + t for t, z in lines if z != NOISE))


def _looks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, look, bare: no line in main, opens: hashes of the open lines) of every page."""
    for batch in batches:
        found = [page_lines(h) for h in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([look_hash(x) for x in found], pa.int64()), pa.array([not any(z == MAIN for _, z in x) for x in found], pa.bool_()),
             pa.array([sorted({line_hash(t) for t, z in x if z == OPEN}) for x in found], pa.list_(pa.int64()))], names=["host", "look", "bare", "opens"])


def _furniture_lines(src: DataFrame) -> DataFrame:
    """(host, look, gone): hashes of the open lines of a page without main that enough distinct pages of the host hold."""
    looks = C.persisted(src.where("host != '' and html != ''").select("host", "html").mapInArrow(_looks, "host string, look long, bare boolean, opens array<long>")
                        .groupBy("host", "look").agg(F.first("bare").alias("bare"), F.first("opens").alias("opens")), "pages-looks")
    looks = looks.join(looks.where("bare and size(opens) > 0").select("host").distinct(), "host", "left_semi")
    rows = looks.select("host", "look", "bare", F.explode("opens").alias("line"))
    held = rows.groupBy("host", "line").agg(F.count("*").alias("held")).where("held > 1")
    furniture = held.join(looks.groupBy("host").agg(F.count("*").alias("pages")), "host").where((F.col("held") >= HOLDERS) | (2 * F.col("held") >= F.col("pages")))
    # lines of one page: bounded by the page; written so that a small table is broadcast and pages are not shuffled again
    gone = rows.where("bare").join(C.persisted(furniture.select("host", "line"), "pages-furniture"), ["host", "line"])
    return C.persisted(gone.groupBy("host", "look").agg(F.collect_set("line").alias("gone")), "pages-gone")


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of all pages, those whose shared open lines wait for evidence settled by it."""
    for batch in batches:
        rows = []
        for *done, lines, gone in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
            if lines is None:
                rows.append(done)
                continue
            pid, url, gone = done[0], done[1], set(gone or ())
            shared = {i for i, x in enumerate(lines) if x["shared"] and (x["zone"] == NOISE or line_hash(x["line"]) in gone)}
            text, n_shared, n_markup = main_text([(x["line"], x["zone"]) for x in lines], shared)
            rows.append((pid, url, text, len(text), n_shared, n_markup))
        if rows:
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                             names=[f.split()[0] for f in TEXTS.split(", ")])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", part_bytes: int = 8 << 20) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, and how many lines went as shared and by markup."""
    src = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    src = (src.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]+://([^/?#]*)", 1)))
           .withColumn("path", F.regexp_extract(F.coalesce("url", F.lit("")), r"^[^:/?#]+://[^/?#]*([^?#]*)", 1))
           .withColumn("h", F.xxhash64("html")))
    size = src.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    lined = with_neighbours(src.where("html != ''"), ["host", "path", "page_id", "h"], max(1, -(-size // part_bytes)), both=True)
    names = [f.split()[0] for f in TEXTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = now = None

        def result(before, now, after):
            near = [p for p in (after, before) if p and now["host"] and p["host"] == now["host"] and p["part"] == now["part"]]
            pair = max(near, key=lambda p: _common_prefix(p["path"], now["path"]), default=None)
            lines = now["lines"]
            shared = shared_lines(lines, pair["lines"] if pair else None)
            waits = any(lines[i][1] == OPEN for i in shared) and not any(z == MAIN for _, z in lines)
            text, n_shared, n_markup = ("", 0, 0) if waits else main_text(lines, shared)
            marked = [{"line": t, "zone": z, "shared": i in shared} for i, (t, z) in enumerate(lines)] if waits else None
            return now["page_id"], now["url"], text, len(text), n_shared, n_markup, now["host"], look_hash(lines), marked

        def batch_of(rows):
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), _LINES]
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                                              names=[*names, "host", "look", "lines"])

        for batch in batches:
            rows = []
            for pid, link, host, path, part, side, body in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                page = {"page_id": pid, "url": link, "host": host, "path": path, "part": part, "side": side, "lines": page_lines(body)}
                if now:
                    if now["side"] == OWN:
                        rows.append(result(before, now, page))
                    if now["side"] != AFTER:
                        before = now
                now = page
            if rows:
                yield batch_of(rows)
        if now and now["side"] == OWN:
            yield batch_of([result(before, now, None)])

    found = lined.select("page_id", "url", "host", "path", "_range", "_side", "html").mapInArrow(run, ALIGNED)
    done = found.join(_furniture_lines(src), ["host", "look"], "left").select(*names, "lines", "gone").mapInArrow(_settle, TEXTS)
    empty = src.where("html = ''").select("page_id", "url", F.lit("").alias("text"), *[F.lit(0).cast("long").alias(c) for c in names[3:]])
    return done.unionByName(empty)
