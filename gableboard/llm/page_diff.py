"""HTML extraction by differencing each page with its nearest neighbours by URL.

A page is read as lines: the text of its blocks, with character references decoded and white space made one
space. Each line is `main` (inside the page's article or main element), `chrome` (inside an element or class
that names a menu, header, footer, sidebar, notice, advert, form or reader comments) or `other`.

Pages are ordered by host, path and id, and each is paired with the page before and after it on its host.
The two pages' lines are aligned by longest common subsequence, and shared lines are deleted, as what two
pages of a site share is their template. Two exceptions keep results right: lines of an article are never
deleted, for neighbours repeat whole articles and passages; and a neighbour that shares nine tenths of all
unmarked and article text is a copy of the page, not a second use of its template, and says nothing. Chrome lines
are left out in any case, as menus and adverts may differ on every page.

What is left is the text: a page's article, and its other lines that no neighbour shares, whether it has an
article or not. A null html is empty. Pages with
a null or relative URL have the host ''. Equal rows are one place in the order, and each has its result; rows
that share a page_id are pages of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
from bisect import bisect_left
from collections import defaultdict
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gableboard.operators.grouping import numbered

#: Least pages of a group, and groups for each partition of a shuffle. A group also gets the page before its
#: first and after its last.
GROUP, PER_TASK = 64, 16
#: Characters of a batch of results.
BATCH = 1 << 22
COPY = 0.9
_BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
_CHROME = frozenset("nav menu header footer aside form dialog button select fieldset".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CHROME_WORDS = frozenset("""ad ads advert adverts advertisement banner sponsor sponsored promo cookie cookies consent notice notices gdpr
nav navbar navigation menu breadcrumb breadcrumbs sidebar side header footer masthead comment comments disqus replies respond share
sharing social related recommended newsletter subscribe subscription signup popup modal login search pagination pager""".split())
#: Parts of a class name that unsay the rest, short words that count alone or beside a place, and such places.
_UNSAID = frozenset("no not non has have with without is hide hidden".split())
_SHORT = frozenset("ad ads side".split())
_PLACES = frozenset("left right top bottom bar box slot unit wrap wrapper container block content area column col panel inner outer".split())
_HIDDEN = re.compile(r"<!--.*?(?:-->|$)|<svg\b[^>]*/>|<(script|style|noscript|template|textarea|svg|iframe|object|canvas|title)\b[^>]*>.*?(?:</\1\s*>|$)"
                     r"|<![^>]*>|<\?[^>]*>", re.S | re.I)
_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _names_chrome(attributes: str) -> bool:
    """Whether a class, id or role names something beside the text, such as `site-footer`, but not `no-sidebar` or `side-by-side`."""
    for m in _NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = [w for w in re.split(r"[^a-z]+", name) if w]
            if not parts or parts[0] in _UNSAID:
                continue
            if any(w in _CHROME_WORDS - _SHORT for w in parts):
                return True
            if any(w in _SHORT for w in parts) and all(w in _SHORT | _PLACES for w in parts) and (len(parts) == 1 or len(set(parts)) > 1):
                return True
    return False


def lines(html: str | None) -> list[tuple[str, str]]:
    """(kind, text) of each line of a page."""
    page = _HIDDEN.sub(" ", html or "")
    out, text, stack = [], [], []

    def kind() -> str:
        if any(k == "chrome" for _, k in stack):
            return "chrome"
        return "main" if any(k == "main" for _, k in stack) else "other"

    def close():
        line = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        if line:
            out.append((kind(), line))

    at = 0
    for tag in _TAG.finditer(page):
        text.append(page[at:tag.start()])
        at = tag.end()
        name = tag[2].lower()
        if name == "br":
            text.append(" ")
            continue
        if name in _BLOCKS:
            close()
        if name in _VOID:
            continue
        if tag[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        if name not in _BLOCKS and name not in _CHROME:
            continue
        if name == "p" or name == "li":  # closed by the next one
            while stack and stack[-1][0] == name:
                stack.pop()
        named = name not in ("body", "html") and _names_chrome(tag[3])
        inside = any(k == "main" for _, k in stack)
        if name in ("article", "main") and not named:
            if not inside:  # an article ends whatever was left open before it
                stack.clear()
            stack.append((name, "main"))
        elif name in _CHROME and not (name == "header" and inside) or named:
            stack.append((name, "chrome"))
        else:
            stack.append((name, ""))
    text.append(re.sub(r"<[^<>]*$", "", page[at:]))
    close()
    return out


def shared(a: list[str], b: list[str]) -> set[int]:
    """Places of `a` in a longest common subsequence of the lines a and b."""
    lo = 0
    while lo < len(a) and lo < len(b) and a[lo] == b[lo]:
        lo += 1
    end_a, end_b = len(a), len(b)
    while end_a > lo and end_b > lo and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    places = defaultdict(list)
    for j in range(end_b - 1, lo - 1, -1):
        places[b[j]].append(j)
    # Matching pairs in order of a, and falling in b: the longest rising run of b is the alignment.
    tails, chain = [], []
    for i in range(lo, end_a):
        for j in places.get(a[i], ()):
            k = bisect_left(tails, j)
            link = (i, chain[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                chain.append(link)
            else:
                tails[k], chain[k] = j, link
    found = {*range(lo), *range(end_a, len(a))}
    link = chain[-1] if chain else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def main_text(page: list[tuple[str, str]], neighbours: list[list[tuple[str, str]]]) -> str:
    texts = [t for _, t in page]
    loose = {i for i, (k, _) in enumerate(page) if k != "main"}
    size = lambda places: sum(len(texts[i]) for i in places if page[i][0] != "chrome")
    drop = set()
    for other in neighbours:
        both = shared(texts, [t for _, t in other])
        if size(both) < COPY * size(range(len(page))):
            drop |= both & loose
    return "\n".join(t for i, (k, t) in enumerate(page) if k != "chrome" and i not in drop)


def _places(batches, kinds: list):
    """group, own, host, page_id, url, lines and number of equal rows of each place, in order."""
    now, known = None, None
    for batch in batches:
        kinds[:] = [batch.schema.field("page_id").type]
        keys = zip(*(batch.column(c).to_pylist() for c in ("group", "own", "host", "h", "page_id", "url")), strict=True)
        for i, (group, own, host, h, page, url) in enumerate(keys):
            if known == (group, h, page):
                now[-1] += 1
                continue
            if now:
                yield now
            now, known = [group, own, host, page, url, lines(batch.column("html")[i].as_py()), 1], (group, h, page)
    if now:
        yield now


def _differ(batches):
    """Rows come sorted by group and place; a task holds three pages at a time."""
    kinds, out, size = [], [], 0

    def told():
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], kinds[0]), pa.array([x[1] for x in out], pa.string()),
                                           pa.array([x[2] for x in out], pa.string())], ["page_id", "url", "text"])

    before = now = None
    for after in chain(_places(batches, kinds), [None]):
        if now and now[0] == now[1]:
            near = [x[5] for x in (before, after) if x and (x[0], x[2]) == (now[0], now[2])]
            text = main_text(now[5], near)
            for _ in range(now[6]):
                out.append((now[3], now[4], text))
                size += len(text) + 100
                if size > BATCH:
                    yield told()
                    out, size = [], 0
        before, now = now, after
    if out:
        yield told()


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text of every row of pages.

    The order is found on the places alone. Its groups are told by their first and last place, so that each
    row finds its group by a binary search, and the pages themselves are shuffled once."""
    spark = pages.sparkSession
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    part = lambda n: F.coalesce(F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://([^/?#]*)([^?#]*)", n), F.lit(""))
    names = ("host", "path", "page_id", "h")
    rows = rows.withColumns({"host": F.lower(part(1)), "path": part(2), "h": F.xxhash64("page_id", "url", "html")})
    ranked = numbered(rows.select(*names).distinct(), [F.col(c) for c in names], "rank")
    # As many groups as the shuffle can use, each of GROUP pages at least: the driver holds two places of each.
    wide = PER_TASK * int(spark.conf.get("spark.sql.shuffle.partitions"))
    pages_each = max(GROUP, math.ceil(ranked.count() / wide))
    place = F.struct(*names)
    ends = (ranked.groupBy(F.floor((F.col("rank") - 1) / pages_each).alias("group"))
            .agg(F.min(place).alias("first"), F.max(place).alias("last")).orderBy("group").collect())
    if not ends:
        return rows.select("page_id", "url", F.lit("").alias("text"))
    kind = rows.schema["page_id"].dataType.simpleString()
    told = lambda name: F.from_json(F.lit(json.dumps([r[name].asDict() for r in ends])),
                                    f"array<struct<host:string,path:string,page_id:{kind},h:bigint>>")

    def halve(a, _):
        middle = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        low = F.get(told("first"), middle) <= place
        step = F.struct(F.when(low, middle + 1).otherwise(a["lo"]).alias("lo"), F.when(low, a["hi"]).otherwise(middle).alias("hi"))
        return F.when(a["lo"] < a["hi"], step).otherwise(a)

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(ends)).alias("hi"))
    steps = F.sequence(F.lit(0), F.lit(len(ends).bit_length()))
    own = F.aggregate(steps, start, halve, lambda a: a["lo"] - 1)
    dealt = rows.withColumn("own", own)
    # A page goes to its own group, and as a neighbour to the one beside it.
    beside = [F.when(F.get(told("first"), F.col("own")) == place, F.col("own") - 1), F.when(F.get(told("last"), F.col("own")) == place, F.col("own") + 1)]
    groups = F.filter(F.array("own", *beside), lambda g: g.between(0, len(ends) - 1))
    dealt = dealt.withColumn("group", F.explode(groups)).repartition("group").sortWithinPartitions("group", *names)
    return dealt.select("group", "own", "host", "h", "page_id", "url", "html").mapInArrow(
        _differ, f"page_id {kind}, url string, text string")
