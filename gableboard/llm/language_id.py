"""Language ID by prediction by partial matching.

Each language has a context tree over bytes, of variable order up to `depth`. The next byte has the
probability count / (total + distinct) in the longest context seen, and what is left, distinct / (total +
distinct), escapes to the next shorter context, where bytes already counted are excluded. Below the empty
context all bytes are alike. So every text has an exact code length under each language's frozen
statistics, and the shortest one names the language.

Bytes are folded first: A-Z become a-z, and each run of other ASCII bytes that are no letters becomes one
separator, so that digits, markup and punctuation say nothing about the language.

A null text, or one without any letter, is `und` with score 0. Repeated rows are judged one by one. The
model is fitted on a bounded sample: per language the `per_language` rows with the smallest hash of id and
text, each taken in whole. Without rows to learn from, every text is `und`. Only the
columns named are read, so further columns of any name are harmless.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gableboard.llm import text_bytes as tb
from gableboard.llm.tables import packed
from gableboard.llm.context_tree import ContextTree, closed

UNKNOWN = "und"
PER_LANGUAGE, DEPTH = 400, 3
#: Parts in which a language is ranked before their first rows are, so that no task ranks more than PARTS * per_language.
PARTS = 32
#: A context must occur so often in some language to be a state of its own.
LEAST = 3


def _symbols() -> np.ndarray:
    """Byte to symbol: 0 separates, 1-26 are letters, then the bytes of other characters."""
    table = np.zeros(256, np.uint8)
    table[ord("a"):ord("z") + 1] = np.arange(1, 27)
    table[0x80:] = np.arange(27, 155)
    return table[tb.FOLD]


SYMBOLS, SIZE = _symbols(), 155


def to_symbols(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the texts, runs of separators as one, and their offsets."""
    lo = offsets[0]
    symbols = SYMBOLS[data[lo:offsets[-1]]]
    keep = np.ones(len(symbols) + 1, bool)
    keep[1:-1] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    starts = (offsets[:-1] - lo)[np.diff(offsets) > 0]
    keep[starts] = True
    places = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=places[1:])
    return symbols[keep[:-1]], places[offsets - lo]


@dataclass
class Model:
    languages: list[str]
    tree: ContextTree
    costs: np.ndarray  # (states, SIZE + 1, languages), bits

    def bits(self, column) -> tuple[np.ndarray, np.ndarray]:
        """Code length of each text under each language, and the number of symbols coded."""
        data, offsets = tb.utf8(column)
        bits, n = np.zeros((len(offsets) - 1, len(self.languages))), np.zeros(len(offsets) - 1, np.int64)
        for i, j in tb.groups(offsets):
            symbols, at = to_symbols(data, offsets[i:j + 1])
            bits[i:j] = self.tree.sums(symbols, at, self.costs)
            n[i:j] = np.diff(at)
        return bits, n


def train(texts: list[str], languages: list[str], depth: int = DEPTH) -> Model | None:
    names = sorted(set(languages))
    if not names:
        return None
    counts: list[dict[tuple, np.ndarray]] = []
    for name in names:
        data, offsets = tb.utf8(pa.array([t for t, g in zip(texts, languages, strict=True) if g == name]))
        symbols, at = to_symbols(data, offsets)
        begin = np.repeat(at[:-1], np.diff(at))
        place = np.arange(len(symbols))
        found: dict[tuple, np.ndarray] = {}
        for d in range(depth + 1):
            ok = place - begin >= d
            code = np.zeros(ok.sum(), np.int64)
            for back in range(d, -1, -1):
                code = code * SIZE + symbols[place[ok] - back]
            grams, times = np.unique(code, return_counts=True)
            contexts, first = np.unique(grams // SIZE, return_index=True)
            for c, a, b in zip(contexts, first, [*first[1:], len(grams)], strict=True):
                key = []
                for _ in range(d):
                    key.append(int(c % SIZE))
                    c //= SIZE
                row = np.zeros(SIZE)
                row[grams[a:b] % SIZE] = times[a:b]
                found[tuple(key[::-1])] = row
        counts.append(found)
    kept = {c for found in counts for c, row in found.items() if row.sum() >= LEAST or not c}
    tree = ContextTree(closed(kept), SIZE)
    costs = np.zeros((len(tree.contexts), SIZE + 1, len(names)), np.float32)
    for g, found in enumerate(counts):
        shares = np.empty((len(tree.contexts), SIZE))
        for i, c in enumerate(tree.contexts):
            shorter = shares[tree.link[i]] if c else np.full(SIZE, 1 / SIZE)
            row = found.get(c)
            if row is None:
                shares[i] = shorter
                continue
            seen, total = row > 0, row.sum()
            rest = shorter[~seen].sum()
            if rest <= 0:
                shares[i] = row / total
                continue
            shares[i] = np.where(seen, row, seen.sum() * shorter / rest) / (total + seen.sum())
        costs[:, :SIZE, g] = -np.log2(shares)
    return Model(names, tree, costs)


def fit(docs: DataFrame, language: str = "lang", text: str = "text", key: str = "doc_id",
        per_language: int = PER_LANGUAGE, depth: int = DEPTH) -> Model | None:
    """Learn from rows of `docs` with a language; at most per_language whole texts for each."""
    rows = docs.select(F.col(language).alias("g"), F.col(text).alias("t"),
                       F.xxhash64(F.col(key), F.col(text)).alias("h"))
    rows = rows.filter(F.col("g").isNotNull() & F.col("t").isNotNull())
    # First the largest hash in each sample, then the texts: none is moved that is not in a sample.
    ranked = rows.select("g", "h", F.pmod("h", F.lit(PARTS)).alias("part"))
    for keys in (["g", "part"], ["g"]):
        order = W.partitionBy(*keys).orderBy("h")
        ranked = ranked.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language).drop("n")
    last = {r["g"]: r["h"] for r in ranked.groupBy("g").agg(F.max("h").alias("h")).collect()}
    within = F.lit(False)
    for g, h in last.items():
        within = within | ((F.col("g") == g) & (F.col("h") <= h))
    found = rows.filter(within).dropDuplicates(["g", "h"]).orderBy("g", "h").collect()
    return train([r["t"] for r in found], [r["g"] for r in found], depth)


def predict(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str | Column] | None = None) -> DataFrame:
    """The columns `keep` of docs with lang_pred, score (of the language among all learned ones) and
    bits (code length per symbol under it; null for `und`)."""
    spark = docs.sparkSession
    kept = docs.select(*(keep or []), F.col(text).alias("_text"),
                       F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    fields = [f for f in kept.schema.fields if f.name not in ("_text", "_letters")]
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            n = batch.num_rows
            letters = np.asarray(batch.column("_letters").to_pylist(), bool) if n else np.zeros(0, bool)
            names, score, per = np.full(n, UNKNOWN, object), np.zeros(n), np.full(n, np.nan)
            if m is not None and n:
                bits, length = m.bits(batch.column("_text"))
                best = bits.argmin(axis=1)
                least = bits[np.arange(n), best]
                share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                names = np.where(letters, np.array(m.languages, object)[best], UNKNOWN)
                score = np.where(letters, share, 0.0)
                per = np.where(letters, least / np.maximum(length, 1), np.nan)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in fields), pa.array(names, pa.string()), pa.array(score),
                 pa.array(per, pa.float64(), from_pandas=True)],
                [*(f.name for f in fields), "lang_pred", "score", "bits"])

    from pyspark.sql import types as T

    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType())])
    return kept.mapInArrow(run, schema)


def identified(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of `docs` that are written in one of the learned languages, unchanged.

    Rejected are texts without any letter, and those that the best language codes no better than a list
    of equally likely letters would (log2 27 bits a symbol): noise, or a script that nobody has learned. Columns of
    any name stay as they are; an empty table stays empty, and without a model no row is kept.
    """
    found = predict(docs.select(packed(docs), F.col(text).alias("said")), model, "said", ["row"])
    ok = (F.col("lang_pred") != UNKNOWN) & (F.col("bits") < float(np.log2(27)))
    return found.filter(ok).select("row.*")
