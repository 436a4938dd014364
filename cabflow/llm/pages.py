"""Main text of web pages by differencing each page with its nearest neighbour on the same host.

A page becomes text lines, one for each block, in page order, each with a zone:
``article`` (inside an article or main element), ``frame`` (inside what HTML or a
class or id names as menu, header, footer, sidebar, notice, advert, form or
comments) or ``body`` (anything else). Pages are put in the order of host and
URL path. Equal pages (of one host, with the same lines and zones) that follow each
other are a run, and get one text: runs are paired with the run before or after
that shares the longer path. The two pages' lines are aligned by longest common
subsequence, whatever markup the neighbour has.

Shared lines of the body zone are deleted: a site repeats them around its texts.
Frame lines are deleted with or without a pair. Lines of an article are kept even
where the neighbour shares them, as mirrored articles and passages that several
articles quote are text. Where a page has a main element, or articles with at least half of
what is not frame, nothing outside of them is text, so that no pair decides there; shorter
articles are cards beside the text, for which the pair decides as on any other page. Names
in a class or an id are hints: in an article they count on containers of adverts and comments
alone, and a heading's id never does. An embedded element (svg, video and the like) is skipped
to its end tag; one that is closed in its own tag, or never, loses its tag alone. A neighbour
that holds all of the page's lines but frame is a copy and says nothing, and so is one without a
line of its own that shares nearly all of the body; the other neighbour is asked instead.

Defined results: null or empty html has the empty text; pages of any length are read whole; a null URL is a host of
its own, with an empty path; broken markup is read as far as it goes; repeated rows are copies of
each other and get one text; an empty table gives an empty table; other columns are not returned.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabflow.llm.common import slices, stored, text_column, unstore
from cabflow.llm.ordered import BUCKET, EDGE, with_runs

COPY_SHARE = 0.8
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
# Elements without text of the page inside, which are skipped where they are closed (see ``_closed``).
SKIPPED = frozenset("noscript template svg math iframe object canvas audio video textarea select title".split())
_SKIPPED = re.compile(rf"<(/?)({'|'.join(sorted(SKIPPED))})\b", re.I)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_ARTICLE_BODY = re.compile(r"\bitemprop\s*=\s*[\"']?articleBody\b", re.I)
_MAIN_ROLE = re.compile(r"\brole\s*=\s*[\"']?(?:main|article)\b", re.I)
_WORDS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary"
    " table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FRAME_TAGS = frozenset("nav footer aside form dialog menu head button fieldset".split())
FRAME_NAMES = frozenset(
    "ad ads adv advert advertisement advertising adverts alert banner banners breadcrumb breadcrumbs comment comments"
    " consent cookie cookies copyright disclaimer disqus footer gdpr legal login masthead menu modal nav navbar"
    " navigation newsletter notice notices notification overlay pager pagination popup promo promotion reactions"
    " related recommended replies reply respond search share sharing sidebar signup skip social sponsor sponsored"
    " subscribe subscription tags toolbar toplinks topbar widget widgets".split()
)
# Inside an article, only containers with one of these names are no text of it.
ASIDE_NAMES = frozenset("ad ads advert advertisement advertising adverts comment comments disqus replies reply respond".split())
CONTAINERS = frozenset("div section ul ol dl table ins details iframe article".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# An element that starts here ends an open paragraph, item or cell of the kind.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
Line = tuple[str, str]


def _named(tag: str, kind: str, value: str, in_article: bool) -> bool:
    """Whether a class or an id says that an element is no text of the page.

    A name is a hint that a site's author gives, not a rule of HTML. In an article it counts on
    containers alone, and only for adverts and comments; a heading's id is an anchor.
    """
    if tag in ("html", "body", "main") or kind == "id" and tag in HEADINGS:
        return False
    found = set(_WORDS.findall(_CAMEL.sub(" ", value).lower()))
    if tag == "article":
        return bool(found & {"comment", "comments", "reply"})
    if in_article:
        return tag in CONTAINERS and bool(found & ASIDE_NAMES)
    return bool(found & FRAME_NAMES) or "header" in found


def _framed(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in FRAME_TAGS or (tag == "header" and not in_article):
        return True
    if not attributes.strip():
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            if _named(tag, name, value, in_article):
                return True
        elif name == "role" and value.lower() in FRAME_ROLES or name == "hidden":
            return True
        elif name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def _closed(html: str) -> dict[int, int]:
    """Where each skipped element that is closed ends: by its start, the start of its end tag.

    An element whose name opens again before it is closed was not closed: only its tag goes, as
    whatever follows it may be the page's text.
    """
    ends, following = {}, {}
    for m in reversed(list(_SKIPPED.finditer(html))):
        name = m[2].lower()
        if m[1]:
            following[name] = m.start()
        elif following.get(name) is not None:
            ends[m.start()] = following[name]
            following[name] = None
    return ends


def lines(html: str) -> list[Line]:
    """(zone, text) of each block with text, in page order."""
    out: list[Line] = []
    held: list[str] = []
    stack: list[tuple[str, str]] = []  # open elements: tag, and the zone inside
    zone = "body"

    def flush() -> None:
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text:
                out.append((zone, text))
            held.clear()

    def close(i: int) -> None:
        nonlocal zone
        del stack[i:]
        zone = stack[-1][1] if stack else "body"

    ends = _closed(html)
    at = 0
    while m := _TOKEN.search(html, at):
        if m.start() > at:
            held.append(html[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in SKIPPED:
            if not m[2] and not m[4].rstrip().endswith("/"):
                at = max(at, ends.get(m.start(), at))
            continue
        block = tag in BLOCKS
        if tag == "br":
            held.append(" ")
            continue
        if m[2]:
            if block:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if not block and stack[i][1] != (stack[i - 1][1] if i else "body"):
                        flush()
                    close(i)
                    break
            continue
        if block:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in ENDS.get(tag, ()):
                    close(i)
                    break
                if stack[i][0] in BLOCKS:
                    break
        if tag in VOID:
            continue
        inside = zone
        if zone != "frame":
            if _framed(tag, m[4] or "", zone in ("article", "main")):
                inside = "frame"
            elif tag == "article" or _ARTICLE_BODY.search(m[4] or ""):
                inside = "article"
            elif zone == "body" and (tag == "main" or _MAIN_ROLE.search(m[4] or "")):
                inside = "main"
        if block or inside != zone:
            if inside != zone and not block:
                flush()
            stack.append((tag, inside))
            zone = inside
    held.append(html[at:])
    flush()
    return _settled(out)


def _settled(out: list[Line]) -> list[Line]:
    """Zones of a whole page, where it is known how much of it stands in articles.

    With a main element, or articles that hold at least half of all that is not frame, nothing
    outside of them is text. Shorter articles are cards beside the text, which stays body.
    """
    size = lambda *zones: sum(len(t) for z, t in out if z in zones)
    within = size("article", "main")
    if not within:
        return out
    outside = "frame" if size("main") or size("article") >= size("body") else "body"
    return [("article" if z in ("article", "main") else "frame" if z == "frame" else outside, t) for z, t in out]


def shared(a: list[str], b: list[str]) -> set[int]:
    """Indices of ``a`` in a longest common subsequence with ``b`` (Hunt and Szymanski)."""
    where: dict[str, list[int]] = {}
    for j, x in enumerate(b):
        where.setdefault(x, []).append(j)
    tails: list[int] = []
    links: list[tuple] = []
    for i, x in enumerate(a):
        for j in reversed(where.get(x, ())):
            k = bisect_left(tails, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            else:
                tails[k] = j
                links[k] = link
    out, link = set(), links[-1] if links else None
    while link:
        out.add(link[0])
        link = link[1]
    return out


def deleted(zones: str, keys: list, sizes: list[int], others: list[tuple[str, list]]) -> set[int]:
    """Indices of body lines shared with the first neighbour that is no copy; lines are equal where their keys are."""
    body = [i for i, z in enumerate(zones) if z == "b"]
    total = sum(sizes[i] for i in body)
    for other_zones, other_keys in others if body else ():
        here, there = set(keys), set(other_keys)
        if all(k in there for z, k in zip(zones, keys, strict=True) if z != "f"):
            continue  # it has the whole page
        common = shared(keys, other_keys) & set(body)
        own = any(z != "f" and k not in here for z, k in zip(other_zones, other_keys, strict=True))
        if own or sum(sizes[i] for i in common) < COPY_SHARE * total:
            return common
    return set()


def main_text(page: list[Line], neighbours: list[list[Line]]) -> str:
    """The page's lines without frame lines, and without body lines shared with the first neighbour that is no copy."""
    split = [("".join(z[0] for z, _ in p), [t for _, t in p]) for p in (page, *neighbours)]
    drop = deleted(*split[0], [len(t) for _, t in page], split[1:])
    return "\n".join(t for i, (z, t) in enumerate(page) if z != "frame" and i not in drop)


def _digest(data: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8).digest(), "little", signed=True)


def _parse(full: bool):
    """Adds each page's hash over its lines and zones; ``full``: also the zones, a hash of every line, and the lines that are not frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_html"):
            parsed = [lines(h) for h in text_column(batch, "_html").to_pylist()]
            zones = ["".join(z[0] for z, _ in p) for p in parsed]
            whole = [_digest("\n".join([z, *(t for _, t in p)]).encode()) for z, p in zip(zones, parsed, strict=True)]
            names = [n for n in batch.schema.names if n != "_html"]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns.append(pa.array(whole, pa.int64()))
            if full:
                columns += [
                    pa.array(zones, pa.string()),
                    pa.array([[_digest(t.encode()) for _, t in p] for p in parsed], pa.list_(pa.int64())),
                    pa.array(["\n".join(t for z, t in p if z != "frame") for p in parsed], pa.string()),
                ]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "_page", *(["_zones", "_keys", "_lines"] if full else [])])

    return run


def _shared_path(key: str, other: str) -> int:
    """How many parts of the path two keys share; -1 on different hosts."""
    (host, _, rest), (other_host, _, other_rest) = key.partition("\x01"), other.partition("\x01")
    if host != other_host:
        return -1
    a, b = ([x for x in r.rpartition("\x01")[0].split("/") if x] for r in (rest, other_rest))
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def _text(row: dict, others: list[dict]) -> str:
    zones = row["_zones"]
    at = [i for i, z in enumerate(zones) if z != "f"]
    texts = row["_lines"].split("\n")
    sizes = dict(zip(at, map(len, texts), strict=False))
    drop = deleted(zones, row["_keys"], [sizes.get(i, 0) for i in range(len(zones))], [(o["_zones"], o["_keys"]) for o in others])
    return "\n".join(t for i, t in zip(at, texts, strict=False) if i not in drop)


def _stream(spans: dict[int, tuple[str, str]]):
    """Texts of pages in order; ``spans`` has the first key of each bucket's first run and the last key of its last run."""

    def result(run: list[tuple], page: dict, first: str, last: str, before: dict | None, after: dict | None) -> Iterator[tuple]:
        near = [(_shared_path(k, o["_k"]), o) for k, o in ((first, before), (last, after)) if o is not None]
        text = _text(page, [o for r, o in sorted(near, key=lambda x: -x[0]) if r >= 0])
        return ((*one, text) for one in run)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        ids, urls, texts = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = before = page = first = last = None
        run: list[tuple] = []  # id and url of equal pages in a row, of which ``page`` is one

        out: list[tuple] = []

        def closed(after: dict | None, end: bool) -> Iterator[pa.RecordBatch]:
            if run:
                for row in result(run, page, first, spans[bucket][1] if end else last["_k"], before, after):
                    out.append(row)
                    if len(out) >= 500:
                        yield batch_of(out)
                        out.clear()

        for batch in batches:
            for now in batch.to_pylist():
                if now[BUCKET] != bucket:
                    yield from closed(None, True)
                    bucket, before, page, run, first = now[BUCKET], None, None, [], spans[now[BUCKET]][0]
                if now[EDGE] < 0:
                    before = now
                elif now[EDGE] > 0:
                    yield from closed(now, True)
                    run = []
                else:
                    if page is not None and now["_run"] != page["_run"]:
                        yield from closed(now, False)
                        before, page, run, first = last, None, [], now["_k"]
                    page, last = page or now, now
                    run.append((now["page_id"], now["url"]))
        yield from closed(None, True)
        if out:
            yield batch_of(out)

    return stream


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rest = F.regexp_replace(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")
    place = F.regexp_replace(rest, r"[?#].*$", "")
    host = F.lower(F.substring_index(place, "/", 1))
    path = F.expr("substring(_place, length(substring_index(_place, '/', 1)) + 1)")
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("_html"),
        place.alias("_place"),
        host.alias("_host"),
    )
    page_id = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    rows = rows.select("page_id", "url", "_html", "_host", F.xxhash64("_html").alias("_tie"), F.concat_ws("\x01", "_host", path, page_id).alias("_k"))
    long, text = T.LongType(), T.StringType()

    def parsed(full: bool, *names: str) -> DataFrame:
        part = rows.select(*names, "_html")
        new = [("_page", long), *([("_zones", text), ("_keys", T.ArrayType(long)), ("_lines", text)] if full else [])]
        schema = T.StructType([*[f for f in part.schema.fields if f.name != "_html"], *[T.StructField(n, k) for n, k in new]])
        return part.mapInArrow(_parse(full), schema).withColumn("_run", F.xxhash64("_host", "_page")).drop("_host", "_page")

    # The order and its runs of equal pages need a narrow table alone.
    keys = stored(parsed(False, "_host", "_k", "_tie").select("_k", "_tie", "_run"), "page-keys")
    ordered, spans = with_runs(parsed(True, "page_id", "url", "_host", "_k", "_tie"), "_k", "_tie", "_run", keys)
    unstore(keys)
    return ordered.mapInArrow(_stream(spans), "page_id long, url string, text string, n_chars long")
