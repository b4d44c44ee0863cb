"""URL filters: a list of rules first, association rules between URL tokens and verdicts for all other URLs.

`listed` judges by the caller's list of (host, path, verdict): the longest rule that fits wins. `fit` mines
labelled URLs with Spark's FP-growth: transactions are a URL's tokens and its verdict, and each frequent set of
tokens X gives the rule X -> verdict with support n(X, verdict) / n and confidence n(X, verdict) / n(X). Rules
below the least confidence go, and so do rules that hold a shorter rule of the same verdict that is as sure.
`judged` matches by an inverted index: a rule stands under its rarest token, a URL looks its tokens up there
and is held against the whole antecedent. The surest rule decides (then the better supported, the shorter, the
smaller by its tokens and verdict, so ties have one answer); where none fits, the default verdict.

A verdict depends only on those tokens of a URL that rules use, so each distinct set of them is matched once,
however many URLs share it: a host with a third of all rows is one set a page form. The tokens that rules use
are frequent ones, of which there are at most (mean tokens of a URL) / (least support).

A null URL, or one without `://`, has an empty host and path, no tokens and gets the default. Repeated rows are
judged alike and counted alike. Without labelled rows, or with an empty table, there are no rules. Very long
URLs are read whole. Of the given tables only the named columns are read, so further columns cannot clash.
Tokens that always occur together are mined as one, which keeps the number of frequent sets small; sets of very
many frequent tokens that nearly always occur together remain costly, as for FP-growth in general.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gableboard.llm.tables import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DEFAULT = "allow"
SUPPORT, CONFIDENCE = 0.005, 0.8
#: Before a verdict among the items of a transaction; tokens start with other letters.
MARK = "verdict:"


def host(url: Column) -> Column:
    """What stands after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*+)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*+([^?#]*+)", 1), F.lit(""))


def listed(at: Column, below: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest (host, path, verdict) that fits a host and a path, else nulls."""
    rule = verdict = F.when(F.lit(False), "")
    for name, start, says in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((at == name) | F.endswith(at, F.lit("." + name))) & F.startswith(below, F.lit(start))
        rule, verdict = rule.when(fits, name + start), verdict.when(fits, says)
    return rule, verdict


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL: its host, the host's labels, path segments and the names of its parameters.

    Numbers in segments count as 0, so that pages of one form share a token.
    """
    at, below = host(url), F.translate(path(url), UPPER, LOWER)
    query = F.coalesce(F.regexp_extract(url, r"(?s)^[^?#]*+\?([^#]*+)", 1), F.lit(""))
    some = lambda parts: F.filter(parts, lambda p: p != "")
    marked = lambda mark, parts: F.transform(some(parts), lambda p: F.concat(F.lit(mark), p))
    return F.array_distinct(F.concat(
        marked("host:", F.array(at)), marked("label:", F.split(at, r"\.")),
        marked("path:", F.split(F.regexp_replace(below, "[0-9]++", "0"), "/")),
        marked("name:", F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1)))))


def _merged(baskets: DataFrame, support: float, rows: int) -> DataFrame:
    """token, kept: frequent tokens, and for each the smallest token that occurs in the same URLs.

    Equal numbers of URLs and equal sums of two hashes of their token sets count as the same URLs.
    """
    part = lambda seed: F.pmod(F.xxhash64("items", F.lit(seed)), F.lit(1 << 31))
    of = baskets.select(F.explode("items").alias("token"), part(1).alias("x"), part(2).alias("y"))
    counted = of.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("decimal(30)")).alias("x"),
                                      F.sum(F.col("y").cast("decimal(30)")).alias("y"))
    frequent = counted.filter(F.col("n") >= support * rows)
    least = frequent.groupBy("n", "x", "y").agg(F.min("token").alias("kept"))
    return frequent.join(least, ["n", "x", "y"]).select("token", "kept", "n")


def fit(urls: DataFrame, url: str = "url", verdict: str = "verdict", support: float = SUPPORT,
        confidence: float = CONFIDENCE) -> DataFrame:
    """Rules (antecedent, anchor, verdict, n, confidence) mined from labelled URLs; rows without a verdict are not read."""
    labelled = urls.filter(F.col(verdict).isNotNull())
    baskets = written(labelled.select(tokens(F.col(url)).alias("items"), F.col(verdict).alias("verdict")), "url-baskets")
    rows = baskets.count()
    frequent = written(_merged(baskets, support, rows), "url-tokens")
    # A scalar: frequent tokens are few, see above.
    kept = frequent.filter("token = kept").agg(F.collect_set("token")).scalar()
    items = F.concat(F.array_intersect("items", kept), F.array(F.concat(F.lit(MARK), F.col("verdict"))))
    transactions = baskets.select(items.alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=support, minConfidence=1.0).fit(transactions).freqItemsets
    found = written(found.select(F.sort_array("items").alias("items"), F.col("freq").alias("n")), "url-itemsets")
    is_mark = lambda t: F.startswith(t, F.lit(MARK))
    sure = found.filter(F.exists("items", is_mark)).select(
        F.filter("items", lambda t: ~is_mark(t)).alias("antecedent"),
        F.substring(F.filter("items", is_mark)[0], len(MARK) + 1, 1 << 30).alias("verdict"), "n")
    of = found.filter(~F.exists("items", is_mark)).select(F.col("items").alias("antecedent"), F.col("n").alias("of"))
    rules = (sure.filter(F.size("antecedent") > 0).join(of, "antecedent")
             .withColumn("confidence", F.col("n") / F.col("of")).filter(F.col("confidence") >= confidence))
    rarest = F.explode("antecedent").alias("token")
    anchors = (rules.select("antecedent", rarest).distinct().join(frequent, "token").groupBy("antecedent")
               .agg(F.min(F.struct("n", "token"))["token"].alias("anchor")))
    rules = written(rules.join(anchors, "antecedent").select("antecedent", "anchor", "verdict", "n", "confidence"), "url-rules")
    # A rule that holds a shorter one, as sure and of the same verdict, decides nothing.
    inside = _matches(rules.select(F.col("antecedent").alias("tokens")).distinct(), rules)
    shorter = inside.filter(F.size("antecedent") < F.size("tokens")).groupBy(
        F.col("tokens").alias("antecedent"), "verdict").agg(F.max("confidence").alias("known"))
    kept = rules.join(shorter, ["antecedent", "verdict"], "left")
    return written(kept.filter(F.coalesce(F.col("confidence") > F.col("known"), F.lit(True))).select(*rules.columns), "url-rules")


def _matches(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Each set of tokens with each rule whose antecedent it holds, by the index of anchors."""
    looked = sets.select("tokens", F.explode("tokens").alias("anchor"))
    return looked.join(rules, "anchor").filter(F.size(F.array_except("antecedent", "tokens")) == 0)


def relevant(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The table with `tokens`: those tokens of its column url that rules use, sorted."""
    used = rules.select(F.explode("antecedent").alias("t")).agg(F.collect_set("t")).scalar()
    return urls.select("*", F.sort_array(F.array_intersect(tokens(F.col("url")), used)).alias("tokens"))


def judged(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """tokens, verdict, because (the deciding antecedent) of every distinct set of tokens that some rule fits."""
    sets = relevant(urls.select("url"), rules).select("tokens").distinct()
    order = F.struct((-F.col("confidence")).alias("c"), (-F.col("n")).alias("n"), F.size("antecedent").alias("s"), "antecedent", "verdict")
    best = _matches(sets, rules).groupBy("tokens").agg(F.min(order).alias("best"))
    return best.select("tokens", "best.verdict", F.col("best.antecedent").alias("because"))


def filtered(urls: DataFrame, listed_rules: Sequence[tuple[str, str, str]], key: str = "page_id", url: str = "url",
             default: str = DEFAULT, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """key, host, path, rule, verdict, because of every row: the list decides, and teaches the method for the rest."""
    rows = urls.select(F.col(key).alias("key"), F.col(url).alias("url"))
    rows = rows.select("key", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, said = listed(F.col("host"), F.col("path"), listed_rules)
    rows = rows.select("*", rule.alias("rule"), said.alias("said"))
    rules = fit(rows, "url", "said", support, confidence)
    # Written, so that Catalyst knows its size.
    found = written(judged(rows, rules), "url-verdicts")
    return relevant(rows, rules).join(found, "tokens", "left").select(
        F.col("key").alias(key), "host", "path", "rule", F.coalesce("said", "verdict", F.lit(default)).alias("verdict"),
        F.when(F.col("said").isNull(), F.array_join("because", " ")).alias("because"))
