"""Main text of web pages, by differencing each page with the one of the nearest URL on its host.

The URLs of a host stand in order of path and query, so a page's neighbour is the URL before or after its own, whichever
begins more alike; URLs whose page is a copy of it are passed over. Lines that a page shares with its neighbour, by a longest
common subsequence, are the site's and not the page's. In pages that mark articles, marked parts are judged as wholes, as near
copies of an article share most of its lines: a part with a line of its own stays whole, one that is all shared (a teaser, a
notice) goes, and so do lines outside. Where no part has a line of its own, all parts stay.
"""

from __future__ import annotations

import os.path
import re
from collections.abc import Iterator, Sequence
from hashlib import blake2b
from html.parser import HTMLParser
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import map_batches, split_among, written

#: Elements that never hold main text, with all they contain.
_DROPPED = frozenset(
    "head title script style noscript template nav aside footer form button select textarea input iframe object svg canvas dialog menu".split()
)
_MARKED = frozenset(("article", "main"))
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements inside a line; all others end it.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr".split()
)
#: Elements whose end may be left out; they are not tracked.
_OPEN_ENDED = frozenset("p li dt dd tr td th thead tbody tfoot option colgroup caption html body".split()) | _INLINE
#: Words of class, id and role values that name menus, adverts, notices and comments. Within a marked element a value counts only if
#: all of its words are such.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo "
    "promoted related replies reply search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
_WORD = re.compile(r"[A-Za-z]+")


class _Lines(HTMLParser):
    """Lines of a page: (text, number of the innermost marked element around it, 0 outside). Parts that never hold main text are left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int]] = []
        self.open: list[tuple[str, bool, int]] = []  # name, dropped, marked element; each with what surrounds it
        self.now: list[str] = []
        self.marks = 0

    def _end_line(self) -> None:
        if self.now:
            text = " ".join("".join(self.now).split())
            if text:
                self.lines.append((text, self.open[-1][2] if self.open else 0))
            self.now = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in _INLINE:
            self._end_line()
        dropped, marked = self.open[-1][1:] if self.open else (False, 0)
        given = [v.lower() for k, v in attrs if k in ("class", "id", "role") and v]
        if marked:  # an article's own heading, and names like market-share, stay
            named = any(set(_WORD.findall(token)) <= _NAMES - {"header"} for v in given for token in v.split() if _WORD.search(token))
        else:
            named = any(w in _NAMES for v in given for w in _WORD.findall(v))
        drop = tag in _DROPPED or tag == "header" and not marked or named and tag not in ("html", "body", *_MARKED)
        hidden = not marked and any(k == "hidden" for k, _ in attrs)
        if tag in _VOID or tag in _OPEN_ENDED and not drop and not hidden:
            return
        if tag in _MARKED:
            self.marks += 1
        self.open.append((tag, dropped or drop or hidden, self.marks if tag in _MARKED else marked))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in _INLINE:
            self._end_line()

    def handle_endtag(self, tag: str) -> None:
        if tag not in _INLINE:
            self._end_line()
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] == tag:
                del self.open[place:]
                return

    def handle_data(self, data: str) -> None:
        if not self.open or not self.open[-1][1]:
            self.now.append(data)


def lines_of(html: str | None) -> list[tuple[str, int]]:
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    parser._end_line()
    return parser.lines


def shared_lines(mine: list, other: list) -> set[int]:
    """Places in ``mine`` of a longest common subsequence with ``other``.

    Rows of the table are bit sets (one bit for each line of ``mine``; a 0 where the length grows), so a row costs a few
    operations on a long integer.
    """
    full = (1 << len(mine)) - 1
    where: dict = {}
    for place, line in enumerate(mine):
        where[line] = where.get(line, 0) | 1 << place
    rows = [full]
    for line in other:
        hit = rows[-1] & where.get(line, 0)
        rows.append((rows[-1] + hit | rows[-1] - hit) & full)
    out, i, j = set(), len(mine), len(other)
    while i and j:
        bit = 1 << (i - 1)
        if rows[j] & bit:
            i -= 1
        elif not rows[j - 1] & bit:
            j -= 1
        else:
            out.add(i - 1)
            i, j = i - 1, j - 1
    return out


def left_out(mine: list[int], parts: list[int], neighbour: list[int] | None) -> list[int]:
    """Places of a page's lines that are the site's, among those that may be kept: marked ones, or all where none is marked.

    Lines are given by hashes, with the marked part of each (0: outside).
    """
    shared = shared_lines(mine, neighbour) if neighbour else set()
    if not any(parts):
        return sorted(shared)
    own = {part for place, part in enumerate(parts) if part and place not in shared}
    marked = [part for part in parts if part]
    return [place for place, part in enumerate(marked) if part not in own] if own else []


def _nearest(path: str, found: Sequence[dict]) -> list[int] | None:
    """Lines of the URL, of at most two, that has more of its beginning in common with ``path``; the earlier one in a tie."""
    if not found:
        return None
    return max(sorted(found, key=lambda u: u["path"]), key=lambda u: len(os.path.commonprefix((path, u["path"]))))["hashes"]


def _hash(line: str) -> int:
    return int.from_bytes(blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _parsed_batch(batch: pa.RecordBatch) -> Iterator[dict]:
    kept, hashes, parts = [], [], []
    for html in batch.column(2).to_pylist():
        lines = lines_of(html)
        marked = any(part for _, part in lines)
        kept.append([text for text, part in lines if part or not marked])
        hashes.append([_hash(text) for text, _ in lines])
        parts.append([part for _, part in lines])
    page_id, url, _, host, path, tie = batch.columns
    yield {"page_id": page_id, "url": url, "host": host, "path": path, "tie": tie, "lines": kept, "hashes": hashes, "parts": parts}


def _differenced_batch(batch: pa.RecordBatch) -> Iterator[dict]:
    rows = zip(*(column.to_pylist() for column in batch.columns), strict=True)
    gone = [(tie, left_out(mine, parts, _nearest(at, near or ()))) for tie, at, mine, parts, near in rows]
    yield {"tie": [tie for tie, places in gone if places], "gone": [places for _, places in gone if places]}


def _joined_batch(batch: pa.RecordBatch) -> Iterator[dict]:
    page_id, url, lines, gone = batch.columns
    texts = []
    for mine, places in zip(lines.to_pylist(), gone.to_pylist(), strict=True):
        without = set(places or ())
        texts.append(" ".join(text for place, text in enumerate(mine) if place not in without))
    yield {"page_id": page_id, "url": url, "text": texts}


#: Parts of a URL: scheme and www. or m. don't name another host; fragment, closing slash and .html no other path.
_START = "^(?:(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//)?"
_HOST = f"regexp_replace(lower(regexp_extract(url, '{_START}([^/?#]*)', 1)), '^(www|m)[.]', '')"
_PATH = f"regexp_replace(regexp_extract(url, '{_START}[^/?#]*([^?#]*)', 1), '([.]html?)?/*$', '')"
_QUERY = "regexp_extract(url, '^[^?#]*([?][^#]*)', 1)"
#: A URL above this share of the pages is dealt among tasks, with a copy of its neighbours for each.
HOT = 1 / 20_000


def _carried(edges: Sequence, first: str, last: str, other: str) -> list[tuple]:
    """part, host and nearest unequal path from the parts gone through before, for the host that a part starts with.

    A part has the path and content of its ``first`` and ``last`` URL and, as ``other``, the nearest unequal path that the
    part itself holds for the last one.
    """
    out, host, path, content, beyond = [], None, None, None, None
    for edge in edges:
        start, end, found = edge[first], edge[last], None
        if start.host == host:
            found = path if start.content != content else beyond
        if found is not None:
            out.append((edge.part, start.host, found))
        inside = end[other]
        if inside is None and end.host == start.host:  # one content from the first URL to the last
            inside = found
        host, path, content, beyond = end.host, end.path, end.content, inside
    return out


def _beside(urls: DataFrame) -> DataFrame:
    """``urls`` (distinct host and path, with content) with the nearest paths ``before`` and ``after`` of other content on the host.

    Ranges of host and path are gone through apart, and a row for each range tells what lies beyond its edges.
    """
    placed = written(urls.repartitionByRange("host", "path").withColumn("part", F.spark_partition_id()))
    for name, order in (("before", "path"), ("after", "path desc")):
        over = f"over (partition by part, host order by {order}"
        last = f"if(content <> lag(content) {over}), lag(path) {over}), null)"
        placed = placed.withColumn("change", F.expr(last)).withColumn(name, F.expr(f"last(change, true) {over} rows between unbounded preceding and current row)"))
    placed = written(placed.drop("change"))
    edges = placed.groupBy("part").agg(
        F.min(F.struct("host", "path", "content", "after")).alias("low"), F.max(F.struct("host", "path", "content", "before")).alias("high")
    )
    edges = edges.orderBy("part").collect()  # a row for each range
    spark, schema = urls.sparkSession, "part int, host string, beyond string"
    for name, beyond in (("before", _carried(edges, "low", "high", "before")), ("after", _carried(edges[::-1], "high", "low", "after"))):
        table = F.broadcast(spark.createDataFrame(beyond, schema))
        placed = placed.join(table, ["part", "host"], "left").withColumn(name, F.coalesce(name, "beyond")).drop("beyond")
    return placed.drop("part", "content")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text for each row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a line is one space, lines are joined by one space. A null or empty
    page has an empty text; a null url has no neighbours, and one without a scheme starts with its host; repeated rows return
    rows like others, all with one text; other columns are ignored. A URL with several pages shows its neighbours the one
    with the smallest page_id.

    Every page is differenced, by hashes of its lines, so texts are not shuffled for it. Each distinct URL's neighbours are
    found in ranges of host and path, and their hashes are joined to all rows of the URL; a hot URL is dealt among tasks.
    Only texts of pages that may lose lines meet the places of those lines.
    """
    rows = pages.selectExpr("cast(page_id as bigint) as page_id", "cast(url as string) as url", "cast(html as string) as html")
    rows = rows.selectExpr("page_id", "url", "html", f"{_HOST} as host", f"concat({_PATH}, {_QUERY}) as path")
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    columns = "page_id long, url string, host string, path string, tie long, lines array<string>, hashes array<long>, parts array<int>"
    parsed = written(map_batches(rows, _parsed_batch, columns))
    placed = parsed.where("host is not null").select("page_id", "host", "path", "tie", "hashes", "parts")
    urls = written(placed.groupBy("host", "path").agg(F.min(F.struct("page_id", "hashes")).hashes.alias("hashes"), F.count("*").alias("n")))
    group = max(1, ceil((urls.agg(F.sum("n")).first()[0] or 0) * HOT))

    asked = _beside(urls.selectExpr("host", "path", "n", "xxhash64(hashes) as content"))
    asked = written(asked.selectExpr("host", "path", f"cast(ceil(n / {group}) as int) as copies", "array_compact(array(before, after)) as near"))
    wanted = asked.selectExpr("host", "path as of", "copies", "explode(near) as path").join(urls.select("host", "path", "hashes"), ["host", "path"])
    near = wanted.groupBy("host", "of", "copies").agg(F.collect_list(F.struct("path", "hashes")).alias("near"))
    near = near.selectExpr("host", "of as path", "near", "explode(sequence(0, copies - 1)) as deal")
    hot = F.broadcast(asked.where("copies > 1").select("host", "path", "copies"))  # 20,000 rows at most
    dealt = placed.join(hot, ["host", "path"], "left").withColumn("deal", F.expr("cast(pmod(tie, coalesce(copies, 1)) as int)"))
    joined = dealt.join(near, ["host", "path", "deal"], "left").select("tie", "path", "hashes", "parts", "near")
    gone = written(map_batches(joined, _differenced_batch, "tie long, gone array<int>"))
    texts = parsed.select("page_id", "url", "tie", "lines")
    some, whole = split_among(texts, "tie", gone.select("tie"))
    some = some.join(gone, "tie", "left").select("page_id", "url", "lines", "gone")
    some = map_batches(some, _joined_batch, "page_id long, url string, text string")
    return whole.selectExpr("page_id", "url", "concat_ws(' ', lines) as text").union(some)
