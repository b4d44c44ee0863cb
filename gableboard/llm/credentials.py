"""Secret scans by multipart credential linking, in Spark expressions and joins only.

Strong finds are reported by themselves: assigned passwords and tokens of 8 characters or more, access keys,
long hexadecimal strings. Weak candidates are no secrets alone: a short password, a `pin: 4711`, a user name.
A weak secret is reported where an identifier or an endpoint stands within `scope` characters of it, and a
weak identifier where a secret, weak or strong, does. Each part is put into every stretch of `scope`
characters that its surroundings touch, and the parts of a stretch are joined by their intervals; a semi-join
keeps what has a complement and makes no pairs. As parts of a kind do not overlap, a stretch holds few.

Spans are code points, end exclusive, ordered by start, then by kind as in KINDS. A null text is empty. Rows
that repeat an id are judged one by one; equal rows get equal results. Null ids are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gableboard.llm.tables import packed, running, written

KINDS = ["assign", "access", "hex", "identifier", "weak", "endpoint"]
SCOPE = 200
SPAN = "array<struct<start:bigint,place:int,end:bigint,kind:string>>"
#: Fixed patterns of the strong kinds: group 2 of an assignment has 8 characters or more.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS, HEX = r"AKIA[A-Z0-9]{12,}", r"[0-9a-f]{32,}"
IDENTIFIER = r"""(?i)\b(user_?name|user|login|account|client_?id|e-?mail)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@=-]{3,})"""
WEAK = r"""(?i)\b(pwd|pass|passphrase|pin|credentials?|auth)["']?\x20*[:=]\x20*["']?([^\s"'<>]{4,})"""
ENDPOINT = r"""(?i)\b(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis)://[^\s"'<>]+"""


def spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0, most: int = 1 << 30) -> Column:
    """Spans of the leftmost matches that do not overlap, of those whose group has least to most characters.

    The text between the matches is split off, so that lengths add up to positions."""
    gaps = F.split(text, pattern, -1)
    matches, values = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group))
    none = F.array().cast(SPAN)

    def step(at, x):
        start = at + F.length(x["gap"])
        end = start + F.length(x["match"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("place"), end.alias("end"), F.lit(kind).alias("kind"))
        return end, F.when(F.length(x["value"]).between(least, most), span)

    rows = F.zip_with(F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.struct(g.alias("gap"), m.alias("match"))),
                      values, lambda x, v: F.struct(x["gap"].alias("gap"), x["match"].alias("match"), v.alias("value")))
    return F.when(text.rlike(pattern), running(rows, SPAN.removeprefix("array<").removesuffix(">"), step)).otherwise(none)


def _strong(text: Column) -> Column:
    return F.concat(spans(text, ASSIGN, "assign", 2, 8), spans(text, ACCESS, "access"), spans(text, HEX, "hex"))


def _weak(text: Column) -> Column:
    return F.concat(spans(text, ASSIGN, "weak", 2, 0, 7), spans(text, WEAK, "weak", 2), spans(text, IDENTIFIER, "identifier", 2),
                    spans(text, ENDPOINT, "endpoint"))


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, h and weak (array of spans): the weak parts that have a complement within the scope.

    parts: doc_id, h, part (start, place, end, kind)."""
    rows = parts.select("doc_id", "h", "part.*").distinct()
    left = rows.filter(F.col("kind").isin("weak", "identifier")).withColumn("stretch", F.floor(F.col("start") / scope))
    touched = F.sequence(F.floor(F.greatest(F.lit(0), F.col("start") - 2 * scope) / scope), F.floor((F.col("end") + scope) / scope))
    right = rows.select(F.col("doc_id").alias("d"), F.col("h").alias("g"), F.col("start").alias("s"), F.col("end").alias("e"),
                        F.col("kind").alias("k"), F.explode(touched).alias("t"))
    near = (F.col("start") - F.col("e") <= scope) & (F.col("s") - F.col("end") <= scope)
    secret, name = F.col("k").isin("assign", "hex", "weak"), F.col("k").isin("access", "identifier", "endpoint")
    fits = F.when(F.col("kind") == "weak", name).otherwise(secret)
    same = left["doc_id"].eqNullSafe(right["d"]) & (left["h"] == right["g"]) & (left["stretch"] == right["t"])
    kept = left.join(right, same & near & fits, "left_semi")
    return kept.groupBy("doc_id", "h").agg(F.collect_set(F.struct("start", "place", "end", "kind")).alias("weak"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """doc_id, h (hash of the text), strong and all (arrays of spans) of every row of docs."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(body).alias("h"), F.array_sort(_strong(body)).alias("strong"),
                       _weak(body).alias("loose"))
    rows = written(rows, "spans")
    parts = rows.filter(F.size("loose") > 0).select("doc_id", "h", F.explode(F.concat("strong", "loose")).alias("part"))
    found = linked(parts, scope).select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "weak")
    same = rows["doc_id"].eqNullSafe(found["d"]) & (rows["h"] == found["g"])
    return rows.join(found, same, "left").select(
        "doc_id", "h", "strong", F.array_sort(F.concat("strong", F.coalesce("weak", F.array().cast(SPAN)))).alias("all"))


def joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """The rows of docs with every reported span of `text` replaced by a mark and n_chars made to fit."""
    names = docs.columns
    body = F.coalesce(F.col("text"), F.lit(""))
    hit = reduce(lambda a, b: a | b, (body.rlike(p) for p in (ASSIGN, ACCESS, HEX, IDENTIFIER, WEAK)))
    found = scan(docs.filter(hit), scope=scope).filter(F.size("all") > 0).select(
        F.col("doc_id").alias("of"), F.col("h").alias("of_h"), "all").dropDuplicates(["of", "of_h"])
    rows = docs.filter(hit).select(packed(docs), F.col("doc_id").alias("id"), F.xxhash64(body).alias("h"), body.alias("said"))
    rows = rows.join(found, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left")

    def step(at, s):
        gap = F.substring(F.col("said"), (at + 1).cast("int"), F.greatest(s["start"] - at, F.lit(0)).cast("int"))
        # Of spans that overlap the first has the mark.
        return F.greatest(at, s["end"]), F.when(s["start"] >= at, F.concat(gap, F.lit(mark)))

    last = F.aggregate("all", F.lit(0).cast("bigint"), lambda at, s: F.greatest(at, s["end"]))
    rest = F.substring(F.col("said"), (last + 1).cast("int"), F.length("said"))
    rows = rows.withColumn("clean", F.when(F.col("all").isNotNull(), F.concat(F.array_join(running(F.col("all"), "string", step), ""), rest)))
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    kept = lambda c: F.col("row").getField(c)
    changed = [F.when(F.col("clean").isNotNull(), new[c]).otherwise(kept(c)).alias(c) if c in new else kept(c).alias(c) for c in names]
    return rows.select(*changed).union(docs.filter(~hit))
