"""Main text of web pages by differencing pages with near URLs.

A page is cut into lines, one a block of its markup. Pages are put in order of their host and URL
path, cut into parts whose ends look across to the neighbouring parts, each run of equal pages is paired with the nearer page before or after it, and the longest
common subsequence of their lines is deleted from all of the run. Lines of marked furniture (menus, adverts, forms and the like) are aligned by their place in
the markup, since their words change from page to page; other lines by place and words.

Every page is differenced. Its marks correct what differencing says of a line in two cases: what an author
marked as the article is kept though the neighbour shares it, as copies of a page and licence lines are,
and furniture no line of the neighbour matches goes all the same. Other lines, inside or outside a marked
article, stay if they neither are shared nor are mostly links.

Defined cases: a null or empty html has an empty text; a page alone on its host has no partner, and its
marks alone decide: a marked article is its text; a null url is a host of its own; a page is never
differenced with an equal one, and equal pages that follow each other get equal texts, as repeated rows do. Unclosed and cut-off markup is read as far as it goes.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from wattloom.llm.common import slices, table
from wattloom.session import written

#: About so many pages, in order of host and path, make a part; what a part does not see of its neighbours goes by the driver, two rows a part.
GROUP_PAGES = 65_536
#: A task places about so many lines at once.
PLACED_LINES = 1 << 22
#: A line is mostly links if over this share of its characters is inside links.
LINKED = 0.5
#: Once a quote in a tag has turned out never to close, a tag's quotes are followed so far only.
QUOTED = 4096

PLAIN, FURNITURE, ARTICLE, MAIN, LINKS = range(5)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_FURNITURE = frozenset("nav footer aside form button select textarea label head title iframe svg canvas object dialog menu datalist audio video".split())
_RAW = ("script", "style", "noscript", "template", "textarea", "title")
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:nav\w*|menu\w*|header|foot\w*|side-?bar\w*|aside|ads?|adv|advert\w*|banner\w*|sponsor\w*|promo\w*|cookie\w*|consent|notice\w*|notification\w*|alert\w*|popup|modal|"
    r"comments?|commentlist|repl(?:y|ies)|respond|disqus|shar(?:e|ing)|social\w*|related|recommend\w*|breadcrumbs?|newsletter|subscri\w*|log-?in|sign-?up|search\w*|toolbar|skip|widgets?|"
    r"paginat\w*|pager|copyright|masthead|hidden|navigation|contentinfo|complementary)(?=$|[\s_-])",
    re.I,
)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_UNSEEN = re.compile(r"(?:^|\s)hidden(?=\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


def _kind_of(name: str, attributes: str, inside_article: bool) -> int:
    """What an element makes of the lines in it, or PLAIN if nothing."""
    marks = ""
    if attributes:
        found = {k.lower(): v.strip("\"'") for k, v in _NAMED.findall(attributes)}
        if found.get("role", "").lower() == "main" or "articlebody" in found.get("itemprop", "").lower():
            return MAIN
        marks = " ".join(found.get(k, "") for k in ("class", "id", "role"))
        if _UNSEEN.search(attributes) and name not in ("html", "body"):
            return FURNITURE
    if name in _FURNITURE or name == "header" and not inside_article:
        return FURNITURE
    if name not in ("html", "body", "main") and marks and _MARKS.search(marks):
        return FURNITURE
    return ARTICLE if name == "article" else MAIN if name == "main" else PLAIN


def lines_of(page: str) -> list[tuple[int, int, str]]:
    """(kind, place in the markup, text) of every block with text, in page order.

    A place is a hash of the names of all open elements, carried on the stack; time and memory are
    linear in the page, however deep its elements nest.
    """
    out: list[tuple[int, int, str]] = []
    stack: list[tuple[str, int, int]] = []
    open_names: dict[str, int] = {}
    held: list[str] = []
    linked = 0
    links = 0  # open links
    kinds = [0] * 5  # open elements of each kind
    last = page.rfind(">")
    quoted = len(page)

    def close() -> str:
        name, kind, _ = stack.pop()
        kinds[kind] -= 1
        open_names[name] -= 1
        return name

    def end_block() -> None:
        nonlocal linked
        text = " ".join(references.unescape("".join(held)).split())
        if text:
            kind = FURNITURE if kinds[FURNITURE] else ARTICLE if kinds[ARTICLE] else MAIN if kinds[MAIN] else LINKS if linked > LINKED * len(text) else PLAIN
            out.append((kind, stack[-1][2] if stack else 0, text))
        held.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        held.append(text)
        if links:
            linked += len(text.strip())

    at = 0
    while at < len(page):
        to = page.find("<", at)
        if to < 0 or to > last:
            add(page[at:])
            break
        if to > at:
            add(page[at:to])
        if page.startswith("<!--", to):
            end = page.find("-->", to + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page[to + 1 : to + 2] in ("!", "?"):
            end = page.find(">", to)
            at = len(page) if end < 0 else end + 1
            continue
        tag = _TAG.match(page, to, min(len(page), to + quoted))
        if not tag and (tag := _LOOSE.match(page, to)):
            quoted = QUOTED
        if not tag:
            add("<")
            at = to + 1
            continue
        at, name = tag.end(), tag[2].lower()
        if tag[1]:
            if name in _BLOCKS:
                end_block()
            if name == "a" and links:
                links -= 1
            if open_names.get(name):
                while close() != name:
                    pass
            continue
        if name in _RAW:
            end = re.compile(f"</{name}\\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in _BLOCKS:
            end_block()
        if name == "br":
            add(" ")
        if name == "a":
            links += 1
        if name in _VOID or tag[3].endswith("/"):
            continue
        if name in ("p", "li") and stack and stack[-1][0] == name:
            close()
        kind = _kind_of(name, tag[3], bool(kinds[ARTICLE]))
        stack.append((name, kind, xxh64_intdigest(name, stack[-1][2] if stack else 0)))
        kinds[kind] += 1
        open_names[name] = open_names.get(name, 0) + 1
    end_block()
    return out


def common_lines(a: list[int], b: list[int]) -> list[bool]:
    """Which entries of ``a`` are in a longest common subsequence with ``b``. One number of len(b) bits an entry holds a row of the table."""
    mine = [False] * len(a)
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        mine[head] = True
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
        mine[len(a) - tail] = True
    middle, other = a[head : len(a) - tail], b[head : len(b) - tail]
    where: dict[int, int] = {}
    for j, key in enumerate(other):
        where[key] = where.get(key, 0) | 1 << j
    full = (1 << len(other)) - 1
    row, rows = full, []
    for key in middle:
        met = row & where.get(key, 0)
        row = ((row + met) | (row - met)) & full
        rows.append(row)
    i, j = len(middle), len(other)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:  # no gain from the j-th entry of b
            j -= 1
        elif i > 1 and not rows[i - 2] >> (j - 1) & 1:  # had already without the i-th entry of a
            i -= 1
        else:
            i, j = i - 1, j - 1
            mine[head + i] = True
    return mine


def main_text(kinds: list[int], texts: list[str], shared: list[bool] | None) -> str:
    """The lines that stay, joined; ``shared`` are those the neighbour has too, None without a neighbour."""
    article = ARTICLE if ARTICLE in kinds else MAIN if MAIN in kinds else None
    if shared is None:
        wanted = PLAIN if article is None else article
        return "\n".join(t for k, t in zip(kinds, texts, strict=True) if k == wanted)
    return "\n".join(
        t for k, t, s in zip(kinds, texts, shared, strict=True)
        if k == article or not s and k not in (FURNITURE, LINKS)
    )


def _near(path: str, other: str) -> int:
    n = 0
    for x, y in zip(path, other, strict=False):
        if x != y:
            break
        n += 1
    return n


class Run(NamedTuple):
    """Equal pages that follow each other: the first and the last, (host, path, print, id), the ids of all, and the keys of the lines of each."""

    first: tuple
    last: tuple
    ids: list[int]
    keys: list[int] | None


Neighbour = tuple[int | None, int]  # its id, if there is one, and how many characters of the path agree
_ALONE: Neighbour = (None, -1)


def _beside(page: tuple, other: tuple | None) -> Neighbour:
    """``other`` as neighbour of ``page``; both are (host, path, print, id)."""
    return (other[3], _near(page[1], other[1])) if other and other[0] == page[0] else _ALONE


def _runs(rows: Iterable[tuple]) -> Iterator[Run]:
    for _, equal in groupby(rows, key=lambda r: (r[0], r[2])):
        first = last = next(equal)
        ids = [first[3]]
        for last in equal:
            ids.append(last[3])
        yield Run(first[:4], last[:4], ids, first[4] if len(first) > 4 else None)


def with_neighbours(rows: Iterable[tuple]) -> Iterator[tuple[Run, Run | None, Run | None, Neighbour, Neighbour]]:
    """Each run of equal pages with the runs and the neighbours before and after it; three runs are held at a time.

    ``rows`` are (host, path, print, id, keys) in order.
    """
    runs = _runs(rows)
    before, run = None, next(runs, None)
    while run:
        after = next(runs, None)
        yield run, before, after, _beside(run.first, before and before.last), _beside(run.last, after and after.first)
        before, run = run, after


def runs_of(rows: list[tuple]) -> list[tuple[int, int, Neighbour, Neighbour]]:
    """Start, end and the neighbours before and after of each run of equal pages."""
    found, start = [], 0
    for run, _, _, before, after in with_neighbours(rows):
        found.append((start, start + len(run.ids), before, after))
        start += len(run.ids)
    return found


def across(edges: dict[int, tuple[tuple, tuple, bool, Neighbour, Neighbour]]) -> list[tuple]:
    """For each part, the neighbour before its first run and the one after its last run, through any number of parts.

    ``edges`` has the first and the last page of a part, if all of it is one run, what follows its first
    run and what precedes its last run inside the part.
    """

    def walk(parts: list[int], near: int) -> dict[int, Neighbour]:
        found, seen, beyond = {}, None, _ALONE  # the last page of the part before, and what lies beyond its run
        for part in parts:
            own, far, single, inside = edges[part][near], edges[part][1 - near], edges[part][2], edges[part][3 + near]
            found[part] = beyond if seen and (seen[0], seen[2]) == (own[0], own[2]) else _beside(own, seen)
            seen, beyond = far, found[part] if single else inside
        return found

    before, after = walk(sorted(edges), 0), walk(sorted(edges, reverse=True), 1)
    return [(part, *before[part], *after[part]) for part in edges]


def host_of(url: str = "url") -> Column:
    return F.regexp_extract(F.lower(F.coalesce(F.col(url), F.lit(""))), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)


_ORDER = (
    "part int, edge int, id long, print long, side int, shared array<boolean>, host string, path string, single boolean, "
    "inside long, inside_near int, keys array<long>, inside_keys array<long>"
)
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<boolean>": pa.list_(pa.bool_()), "array<long>": pa.list_(pa.int64())}


def _ordered_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(host, path, print, id, keys) of the pages of a part; rows of the same page follow each other and count once."""
    seen = None
    for batch in batches:
        keys = batch.column("keys")
        for i, (host, path, digest, own) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("host", "path", "print", "id")), strict=True)):
            if seen != (digest, own):
                seen = digest, own
                yield host, path, digest, own, keys[i]


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A part in order: its pages with the lines their neighbour in the part has too (edge 0), and its first and last page (1, 2).

    A page of the first run is on side 0, one of another last run on side 1: its neighbour may be in another part.
    A task holds the lines of three runs, not those of its part.
    """
    part = TaskContext.get().partitionId()
    schema = pa.schema([(n, _ARROW[t]) for n, t in (f.split() for f in _ORDER.split(", "))])

    def placed() -> Iterator[tuple]:
        for run, left, right, before, after in with_neighbours(_ordered_pages(batches)):
            beside = [None if near is _ALONE else other.keys.as_py() for near, other in ((before, left), (after, right))]
            keys, other = run.keys.as_py(), beside[after[1] > before[1]]
            shared = None if other is None else common_lines(keys, other)
            side = 0 if left is None else 1 if right is None else None
            for own in run.ids:
                yield (part, 0, own, run.first[2], side, shared, *[None] * 7)
            single = left is None and right is None
            for edge, at_edge, (host, path, digest, own), inside in ((1, left is None, run.first, 1), (2, right is None, run.last, 0)):
                if at_edge:
                    yield (part, edge, own, digest, None, None, host, path, single, *(before, after)[inside], keys, beside[inside])

    out, held = [], 0
    for row in placed():
        out.append(row)
        held += len(row[5] or ())
        if len(out) == 8192 or held > PLACED_LINES:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out, held = [], 0
    if out:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def partners_across(edges: dict[int, dict]) -> list[tuple[int, int, int, int]]:
    """part, side, page and partner of each border run whose nearer neighbour is in another part; ``edges`` has the two edge rows of a part."""
    inside = {part: [(r["inside"], r["inside_near"]) for r in (e[1], e[2])] for part, e in edges.items()}
    pages = {part: [(r["host"], r["path"], r["print"], r["id"]) for r in (e[1], e[2])] for part, e in edges.items()}
    beyond = across({part: (*pages[part], e[1]["single"], inside[part][1], inside[part][0]) for part, e in edges.items()})
    found = []
    for part, before, before_near, after, after_near in beyond:
        if edges[part][1]["single"]:
            found.append((part, 0, pages[part][0][3], after if after_near > before_near else before))
            continue
        if before_near >= inside[part][0][1]:
            found.append((part, 0, pages[part][0][3], before))
        if after_near > inside[part][1][1]:
            found.append((part, 1, pages[part][1][3], after))
    return [f for f in found if f[3] is not None]


def differences(lines: DataFrame) -> DataFrame:
    """id, print and the shared lines of every page; null for a page without a neighbour.

    The whole table is cut into parts by its order, and an order has no group: a host of any size is
    spread, and a page meets its true neighbours wherever parts end.
    """
    spark = lines.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines.count() // GROUP_PAGES))
    by = ["host", "path", "page_id", "print", "id"]
    ordered = lines.select(*by, "keys").repartitionByRange(parts, *by).sortWithinPartitions(*by)
    placed = written(ordered.select("host", "path", "print", "id", "keys").mapInArrow(_place, _ORDER), "order")
    ends: dict[int, dict] = {}
    borders = placed.where("edge > 0")
    for r in borders.select("part", "edge", "id", "print", "host", "path", "single", "inside", "inside_near").collect():  # two rows a part
        ends.setdefault(r["part"], {})[r["edge"]] = r
    wanted = spark.createDataFrame(partners_across(ends), "part int, side int, id long, partner long")
    known = borders.select("id", "keys").unionByName(borders.selectExpr("inside as id", "inside_keys as keys").where("id is not null")).dropDuplicates(["id"])
    pairs = wanted.join(known, "id").join(known.selectExpr("id as partner", "keys as other"), "partner").select("part", "side", "keys", "other")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            shared = [common_lines(own.as_py(), other.as_py()) for own, other in zip(part.column("keys"), part.column("other"), strict=True)]
            yield pa.record_batch([part.column("part"), part.column("side"), pa.array(shared, pa.list_(pa.bool_()))], names=["part", "side", "across"])

    over = written(pairs.mapInArrow(compared, "part int, side int, across array<boolean>"), "borders")
    said = placed.where("edge = 0").select("part", "side", "id", "print", "shared").join(F.broadcast(over), ["part", "side"], "left")  # two rows a part
    return said.selectExpr("id", "print", "coalesce(across, shared) as shared")


def _keys_of(found: list[tuple[int, int, str]]) -> tuple[list[int], int]:
    """What the lines of a page are aligned by, and the print of the page."""
    keys = [xxh64_intdigest(f"{place}\n{'' if k == FURNITURE else t}") - 2**63 for k, place, t in found]
    return keys, xxh64_intdigest(pa.array(keys, pa.int64()).to_numpy().tobytes()) - 2**63


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    Pages are read twice, first for the keys of their lines, then for their texts, which meet what
    differencing says of them: so texts are shuffled once and never written. A page is known by a hash
    of its host, path, page_id and print, which rows have in common only in a run of equal pages.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    path = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", "")
    rows = pages.select("page_id", "url", host_of().alias("host"), path.alias("path"), F.col("html").cast("binary").alias("text"))
    own_id = F.xxhash64("host", "path", "page_id", "print").alias("id")

    def parsed(part: pa.RecordBatch) -> list[list[tuple[int, int, str]]]:
        return [lines_of((value.as_py() or b"").decode("utf-8", "replace")) for value in part.column("text")]

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys, prints = zip(*map(_keys_of, parsed(part)), strict=True)
            columns = [part.column(c) for c in ("page_id", "host", "path")]
            yield pa.record_batch([*columns, pa.array(keys, pa.list_(pa.int64())), pa.array(prints, pa.int64())], names=["page_id", "host", "path", "keys", "print"])

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            pages_of_part = parsed(part)
            prints = [_keys_of(found)[1] for found in pages_of_part]
            kinds = [[k for k, _, _ in found] for found in pages_of_part]
            texts = [["" if k in (FURNITURE, LINKS) else t for k, _, t in found] for found in pages_of_part]
            made = [pa.array(prints, pa.int64()), pa.array(kinds, pa.list_(pa.int8())), pa.array(texts, pa.list_(pa.string()))]
            yield pa.record_batch([*(part.column(c) for c in ("page_id", "url", "host", "path")), *made], names=["page_id", "url", "host", "path", "print", "kinds", "texts"])

    schema = f"page_id {kind}, host string, path string, keys array<long>, print long"
    lines = written(rows.select("page_id", "host", "path", "text").mapInArrow(keyed, schema).select(own_id, "*"), "lines")
    schema = f"page_id {kind}, url string, host string, path string, print long, kinds array<tinyint>, texts array<string>"
    texts = rows.mapInArrow(worded, schema).select(own_id, "print", "page_id", "url", "kinds", "texts")

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = [main_text(*(value.as_py() for value in line)) for line in zip(*(part.column(c) for c in ("kinds", "texts", "shared")), strict=True)]
                yield pa.record_batch([part.column("page_id"), part.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    # A row a page on either side: they are merged, never broadcast, so that small tables run the plan of large ones.
    decided = texts.join(differences(lines).hint("merge"), ["id", "print"], "left").select("page_id", "url", "kinds", "texts", "shared")
    return decided.mapInArrow(kept, f"page_id {kind}, url string, text string").withColumn("n_chars", F.length("text").cast("long"))


def op8_page_differencing(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
