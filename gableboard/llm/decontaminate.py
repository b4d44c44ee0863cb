"""Benchmark decontamination by a prefix-filtered join of windows with documents.

A benchmark item is cut into windows of `size` consecutive words (an item of fewer words is one window).
A document contains a window only if it contains all its shingles, so one necessary shingle, its prefix
under the order of rarity, is enough to find every occurrence. The join goes as follows:

1. Count the windows' shingles (SHINGLE words, or the whole window where that is shorter) in all documents.
2. Take each window's rarest shingle as its prefix. A window whose rarest shingle is nowhere is dropped.
3. Report each place of a document where a prefix may stand, with the words around it, and join the places
   to the windows of that prefix by its hash.
4. Bound the place: the window must begin at or after the first word and end at or before the last. Then
   compare all its words.

Documents only ever meet a bit filter of the prefixes, of fixed size; the windows themselves are joined,
not broadcast. Windows beyond `windows_per_pass` are handled in further passes, so that the filter stays
selective at any size of the benchmark.

A null text, or one without words, has no words and is clean. Rows that repeat an id are judged one by one;
equal rows get equal results. Items that share an id count as one, null item ids are left out, and an empty
benchmark leaves all documents clean.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gableboard.llm import text_bytes as tb
from gableboard.llm.tables import packed, written

SIZE, SHINGLE = 13, 4
WINDOWS_PER_PASS = 1 << 18
FILTER_BITS = 1 << 24
#: A document is contaminated if 1 / SHARE of its words or more are hit.
SHARE = 20


def _windows(items: DataFrame, size: int, shingle: int) -> DataFrame:
    """item_id, window (its words), m (their number), shingles (hashes, one for each place)."""

    def run(batches):
        for batch in batches:
            data, offsets = tb.utf8(batch.column(1))
            starts, ends, first = tb.spans(data, offsets, tb.LETTERS_DIGITS)
            hashes = tb.word_hashes(data, starts, ends)
            out = {"item_id": [], "window": [], "m": [], "shingles": []}
            for item, a, b in zip(batch.column(0).to_pylist(), first[:-1], first[1:], strict=True):
                m = min(size, int(b - a))
                words = [tb.folded(data, starts[i], ends[i]).decode() for i in range(a, b)]
                parts = tb.shingle_hashes(hashes[a:b], min(shingle, m)).view(np.int64) if m else ()
                for i in range(b - a - m + 1 if m else 0):
                    out["item_id"].append(item)
                    out["window"].append(" ".join(words[i:i + m]))
                    out["m"].append(m)
                    out["shingles"].append(parts[i:i + m - min(shingle, m) + 1].tolist())
            yield pa.RecordBatch.from_pydict(out, schema)

    schema = pa.schema([("item_id", pa.int64()), ("window", pa.string()), ("m", pa.int32()), ("shingles", pa.list_(pa.int64()))])
    return items.mapInArrow(run, "item_id long, window string, m int, shingles array<long>")


def bit_filter(hashes: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A filter of `bits` bits of the column `hash`; at most bits / 64 rows reach the driver."""
    low = F.col("hash").bitwiseAND(F.lit(bits - 1))
    rows = (hashes.select(F.shiftright(low, 6).alias("w"), F.expr(f"shiftleft(1L, int(hash & 63))").alias("m"))
            .groupBy("w").agg(F.bit_or("m").alias("m")).toArrow())
    out = np.zeros(bits // 64, np.int64)
    out[rows.column("w").to_numpy()] = rows.column("m").to_numpy()
    return out.view(np.uint64)


def passes(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    low = hashes & np.uint64(len(table) * 64 - 1)
    return (table[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) != 0


def _places(hashes: np.ndarray, first: np.ndarray, length: int, table: np.ndarray):
    """Places of shingles within one text that pass the filter, and the text of each."""
    parts = tb.shingle_hashes(hashes, length)
    at = np.flatnonzero(passes(parts, table))
    row = np.searchsorted(first, at, "right") - 1
    inside = at + length <= first[row + 1]
    return parts, at[inside], row[inside]


def _counts(docs: DataFrame, lengths: list[int], table: np.ndarray) -> DataFrame:
    """hash, n of the shingles of all documents that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in batches:
            data, offsets = tb.utf8(batch.column("text"))
            met = [np.zeros(0, np.uint64)]
            for i, j in tb.groups(offsets):
                starts, ends, first = tb.spans(data, offsets[i:j + 1], tb.LETTERS_DIGITS)
                hashes = tb.word_hashes(data, starts, ends)
                for length in lengths:
                    parts, at, _ = _places(hashes, first, length, shared.value)
                    met.append(parts[at])
            found, n = np.unique(np.concatenate(met), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])

    return docs.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _hits(docs: DataFrame, lengths: list[int], table: np.ndarray, size: int) -> DataFrame:
    """doc_id, h, n_words of every row; and rows with hash, at, around, lead for each place that passes.

    `around`: the words up to `size` - 1 before and after the shingle; `lead`: how many stand before it."""
    shared = docs.sparkSession.sparkContext.broadcast(table)
    names = ["doc_id", "h", "n_words", "hash", "at", "around", "lead"]

    def run(batches):
        for batch in batches:
            data, offsets = tb.utf8(batch.column("text"))
            n_words, rows = np.zeros(batch.num_rows, np.int64), []
            for i, j in tb.groups(offsets):
                starts, ends, first = tb.spans(data, offsets[i:j + 1], tb.LETTERS_DIGITS)
                hashes = tb.word_hashes(data, starts, ends)
                n_words[i:j] = np.diff(first)
                for length in lengths:
                    parts, at, row = _places(hashes, first, length, shared.value)
                    for p, r in zip(at, row, strict=True):
                        a, b = max(first[r], p - size + 1), min(first[r + 1], p + length + size - 1)
                        words = b" ".join(tb.folded(data, starts[w], ends[w]) for w in range(a, b))
                        rows.append((i + r, int(parts[p].astype(np.int64)), int(p - first[r]), words.decode(), int(p - a)))
            ids, keys = batch.column("doc_id"), batch.column("h")
            nothing = lambda kind: pa.nulls(batch.num_rows, kind)
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(n_words), nothing(pa.int64()), nothing(pa.int64()),
                                              nothing(pa.string()), nothing(pa.int64())], names)
            if rows:
                row, *rest = zip(*rows, strict=True)
                take = pa.array(row, pa.int64())
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), keys.take(take), pa.array(n_words[list(row)]),
                     *(pa.array(x, kind) for x, kind in zip(rest, kinds, strict=True))], names)

    return docs.mapInArrow(run, "doc_id long, h long, n_words long, hash long, at long, around string, lead long")


def hits(docs: DataFrame, items: DataFrame, size: int = SIZE, shingle: int = SHINGLE, key: str = "doc_id",
         text: str = "text", item: str = "item_id", windows_per_pass: int = WINDOWS_PER_PASS) -> DataFrame:
    """doc_id, h (hash of the text), n_words, n_hit, items (sorted ids as text) for every row of docs."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    items = items.select(F.col(item).cast("long").alias("item_id"), F.col("text")).filter("item_id is not null")
    windows = written(_windows(items, size, shingle), "windows")
    known = windows.dropDuplicates(["window"]).drop("item_id")
    count = known.count()
    n_passes = max(1, math.ceil(count / windows_per_pass))
    lengths = sorted({min(shingle, r["m"]) for r in known.select("m").distinct().collect()})
    occurrences, documents = None, None
    for turn in range(n_passes):
        part = known.filter(F.pmod(F.xxhash64("window"), F.lit(n_passes)) == turn)
        parts = part.select("window", "m", F.posexplode("shingles").alias("offset", "hash"))
        counts = _counts(docs, lengths, bit_filter(parts.select("hash")))
        rarest = F.min(F.struct("n", "hash", "offset")).alias("p")
        # No document has all of a window one of whose shingles has no count.
        prefixes = parts.join(counts, "hash", "left").withColumn("n", F.coalesce("n", F.lit(0))).groupBy("window", "m").agg(rarest)
        prefixes = written(prefixes.filter("p.n > 0").select("window", "m", "p.hash", "p.offset"), "prefixes")
        found = written(_hits(docs, lengths, bit_filter(prefixes.select("hash")), size), "hits")
        documents = documents or found.filter("hash is null").select("doc_id", "h", "n_words")
        places = found.filter("hash is not null").join(prefixes, "hash")
        fits = (F.col("at") >= F.col("offset")) & (F.col("lead") >= F.col("offset")) & (
            F.col("at") - F.col("offset") + F.col("m") <= F.col("n_words"))
        words = F.slice(F.split("around", " "), (F.col("lead") - F.col("offset") + 1).cast("int"), F.col("m"))
        places = places.filter(fits).filter(F.array_join(words, " ") == F.col("window")).select(
            "doc_id", "h", (F.col("at") - F.col("offset")).alias("start"), "m", "window").distinct()
        occurrences = places if occurrences is None else occurrences.union(places)
    occurrences = written(occurrences, "occurrences")
    row = ["doc_id", "h"]
    before = W.partitionBy(*row).orderBy("start", "m").rowsBetween(W.unboundedPreceding, -1)
    reach = F.greatest(F.col("start"), F.coalesce(F.max(F.col("start") + F.col("m")).over(before), F.lit(0)))
    covered = (occurrences.groupBy(*row, "start").agg(F.max("m").alias("m"))
               .withColumn("new", F.greatest(F.lit(0), F.col("start") + F.col("m") - reach)).groupBy(*row).agg(F.sum("new").alias("n_hit")))
    of = (occurrences.select(*row, "window").distinct().join(windows.select("item_id", "window").distinct(), "window")
          .groupBy(*row).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    of = of.select(F.col("doc_id").alias("d"), F.col("h").alias("g"), "items")
    # A null id is an id here too.
    both = covered.join(of, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("g"))).select("d", "g", "n_hit", "items")
    same = documents["doc_id"].eqNullSafe(both["d"]) & (documents["h"] == both["g"])
    return documents.join(both, same, "left").select(
        "doc_id", "h", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contaminated(share: int = SHARE):
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of docs that are not contaminated, unchanged."""
    bad = hits(docs, items, **options).filter(contaminated()).select(F.col("doc_id").alias("of"), F.col("h").alias("of_h")).distinct()
    rows = docs.select(packed(docs), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("h"))
    return rows.join(bad, F.col("id").eqNullSafe(F.col("of")) & (F.col("h") == F.col("of_h")), "left_anti").select("row.*")
