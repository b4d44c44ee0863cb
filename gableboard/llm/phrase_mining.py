"""Phrase collocations by dynamic itemset counting.

Documents are dealt over shards, row by row, and the shards are scanned in a cycle. A scan counts phrases of all lengths at
once: words from the first step on, a longer phrase from the step after that by which both its subphrases (without
its last, without its first word) have reached the threshold, each for one full cycle. Lengths so interleave,
instead of a pass over all data for each. Scanning ends when no subphrase has become frequent during the last cycle.

A step's counts are added up with those of the last cycle's other steps, each of which saw another shard. So a
sum never exceeds a phrase's frequency, and equals it once the phrase has been counted for its cycle: the
greatest sum is the frequency, and a phrase whose frequency reaches the threshold cannot be missed, as its
subphrases reach it too. Tasks learn which subphrases are frequent from bit arrays of a fixed size (BITS a
length; two bits a phrase). Where such an array is wrong, a phrase is counted that need not be, never the reverse;
with very many frequent phrases the arrays fill up, and then save less shuffling.

Words are counted by 64-bit hashes inside a chunk of text of at most CHUNK bytes (or one longer text), strings
across chunks. Counts are combined in the task before they are shuffled, so a phrase or language with a third of all
rows is one row a chunk. Texts are scanned whole.

A null text is empty, a null language `und`; repeated rows count each; texts without words give nothing; an
empty table gives an empty result. Ties are broken as `collocations` states. Only lang and text are read, so
further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from gableboard.llm.tables import shared_folder, written
from gableboard.llm.text_bytes import FOLD, groups, mix, shingle_hashes, spans, utf8, word_hashes

SHARDS, LONGEST, LEAST, PER_LANG = 2, 4, 30, 2000
#: A candidate goes where a longer one that holds it has this share (per cent) of its occurrences.
COVERED = 80
PARTS = 64
CHUNK = 1 << 22
#: Bits of one array, and of one row of it as Spark's bitmap aggregate makes them.
BITS, ROW_BITS = 1 << 24, 1 << 15
IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E), *b".,;:!?"]] = False
IS_CUT = ~IS_WORD
IS_CUT[[0x20, 0x09]] = False
COUNTS = "lang string, size int, phrase string, n long"


def _language_hashes(langs: pa.Array) -> np.ndarray:
    """A hash of each row's language."""
    coded = langs.dictionary_encode()
    known = mix(np.array([crc32(x.encode()) for x in coded.dictionary.to_pylist()], np.uint64))
    return known[coded.indices.to_numpy(zero_copy_only=False)]


def _phrase_hashes(words: np.ndarray, langs: np.ndarray, size: int) -> np.ndarray:
    """A hash of the phrase of `size` words from each word on; `langs` are the words' languages."""
    found = shingle_hashes(words, size)
    return mix(found ^ langs[:len(found)])


def _bit_places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(bits - 1)
    return (hashes & low).astype(np.int64), (hashes >> np.uint64(32) & low).astype(np.int64)


def _holds(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    a, b = _bit_places(hashes, 8 * len(bits))
    return ((bits[a >> 3] >> (a & 7)) & (bits[b >> 3] >> (b & 7)) & 1).astype(bool)


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The folded words [start, end)."""
    lengths = ends - starts
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    picked = FOLD[data[np.arange(at[-1]) + np.repeat(starts - at[:-1], lengths)]]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(picked))


def _counted(data: np.ndarray, at: np.ndarray, langs: pa.Array, first_cycle: bool, bits: dict) -> Iterator[pa.RecordBatch]:
    """Phrases of a chunk of texts that are to be counted now, each with its number of occurrences."""
    starts, ends, first = spans(data, at, IS_WORD)
    if not len(starts):
        return
    text_of = np.repeat(np.arange(len(at) - 1), np.diff(first))
    lang = _language_hashes(langs)[text_of]
    words = word_hashes(data, starts, ends)
    cuts = np.zeros(at[-1] - at[0] + 1, np.int64)
    np.cumsum(IS_CUT[data[at[0]:at[-1]]], out=cuts[1:])
    together = (cuts[starts[1:] - at[0]] == cuts[ends[:-1] - at[0]]) & (text_of[1:] == text_of[:-1])

    def rows(size: int, where: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        _, place, n = np.unique(hashes, return_index=True, return_counts=True)
        example = where[place]
        parts = [_strings(data, starts[example + k], ends[example + k]) for k in range(size)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if size > 1 else parts[0]
        return pa.RecordBatch.from_arrays(
            [langs.take(pa.array(text_of[example])), pa.array(np.full(len(n), size, np.int32)), phrase.cast(pa.string()), pa.array(n.astype(np.int64))],
            ["lang", "size", "phrase", "n"])

    if first_cycle:
        total = pa.table({"lang": langs, "n": pa.array(np.diff(first))}).group_by("lang").aggregate([("n", "sum")])
        some = len(total)
        yield pa.RecordBatch.from_arrays(
            [total["lang"].combine_chunks(), pa.array(np.zeros(some, np.int32)), pa.array([""] * some), total["n_sum"].combine_chunks().cast(pa.int64())],
            ["lang", "size", "phrase", "n"])
        yield rows(1, np.arange(len(words)), _phrase_hashes(words, lang, 1))
    whole, hashes = np.ones(len(words), bool), None
    for size in range(2, LONGEST + 1):
        if (size - 1, "known") not in bits or len(words) < size:
            return
        sub = hashes if hashes is not None else _phrase_hashes(words, lang, size - 1)
        known = whole & _holds(bits[size - 1, "known"], sub)
        whole = whole[:-1] & together[size - 2:]
        hashes = _phrase_hashes(words, lang, size)
        if (size - 1, "new") in bits:
            new = known & _holds(bits[size - 1, "new"], sub)
            where = np.flatnonzero(whole & known[:-1] & known[1:] & (new[:-1] | new[1:]))
            if len(where):
                yield rows(size, where, hashes[where])


def _scan(first_cycle: bool, shared, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = {k: np.frombuffer(v, np.uint8) for k, v in shared.value.items()}
        for batch in batches:
            data, at = utf8(batch.column("text"))
            for i, j in groups(at, chunk):
                yield from _counted(data, at[i:j + 1], batch.column("lang").slice(i, j - i), first_cycle, bits)
    return run


def _places(bits: int):
    """size, which, row, bit of each frequent phrase in the bit arrays."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            data, at = utf8(batch.column("phrase"))
            starts, ends, first = spans(data, at, IS_WORD)
            sizes, fresh = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("size", "new"))
            words = word_hashes(data, starts, ends)
            langs = np.repeat(_language_hashes(batch.column("lang")), np.diff(first))
            out = []
            for size in np.unique(sizes):
                of = sizes == size
                for place in _bit_places(_phrase_hashes(words, langs, int(size))[first[:-1][of]], bits):
                    out += [(size, "known", place), (size, "new", place[fresh[of].astype(bool)])]
            n = [len(p) for *_, p in out]
            place = np.concatenate([p for *_, p in out])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([int(s) for s, *_ in out], n).astype(np.int32)), pa.array(np.repeat([w for _, w, _ in out], n)),
                 pa.array((place // ROW_BITS).astype(np.int32)), pa.array(place % ROW_BITS)], ["size", "which", "row", "bit"])
    return run


def _bit_arrays(frequent: DataFrame, since: int, bits: int) -> dict:
    """(size, known or new) to the bits of the phrases that may be subphrases; new ones became frequent at step `since` or later."""
    subs = frequent.filter(F.col("size").between(1, LONGEST - 1)).select("lang", "size", "phrase", (F.col("step") >= since).alias("new"))
    rows = (subs.mapInArrow(_places(bits), "size int, which string, row int, bit long").groupBy("size", "which", "row")
            .agg(F.bitmap_construct_agg("bit").alias("bits")))
    arrays: dict = {}
    # At most 2 * (LONGEST - 1) * bits / ROW_BITS rows of 4 KB: 12 MB.
    for r in rows.collect():
        arrays.setdefault((r["size"], r["which"]), bytearray(bits // 8))[r["row"] * ROW_BITS // 8:(r["row"] + 1) * ROW_BITS // 8] = r["bits"]
    return {k: bytes(v) for k, v in arrays.items()}


def frequencies(docs: DataFrame, shards: int = SHARDS, least: int = LEAST, size: int = BITS, chunk: int = CHUNK) -> DataFrame:
    """lang, size, phrase, n: phrases of up to LONGEST words that occur `least` times or more in a language, and how often.

    Size 0 holds the number of all words of a language (where it reaches `least`). `size` (bits, a power of two of
    ROW_BITS or more) and `chunk` (bytes) bound memory and do not change the result.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "phrase-shards")
    dealt = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text",
                        (F.monotonically_increasing_id() % shards).cast("int").alias("shard"))
    dealt.write.partitionBy("shard").parquet(folder)
    dealt = spark.read.schema("lang string, text string, shard int").parquet(folder)
    keys, step, parts, bits = ["lang", "size", "phrase"], 0, [], {}
    frequent = spark.createDataFrame([], COUNTS + ", step int")
    while step < shards or any(which == "new" for _, which in bits):
        shared = spark.sparkContext.broadcast(bits)
        now = dealt.filter(F.col("shard") == step % shards).select("lang", "text").mapInArrow(_scan(step < shards, shared, chunk), COUNTS)
        rows = now.withColumn("before", F.lit(0).cast("long"))
        for part in parts:
            rows = rows.unionByName(part.select(*keys, F.lit(0).cast("long").alias("n"), F.col("n").alias("before")))
        summed = rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.col("n") + F.col("before")).alias("total"))
        part = written(summed.filter("n > 0"), f"phrases-{step}")
        shared.unpersist()
        reached = part.filter(F.col("total") >= least).select(*keys, F.col("total").alias("n"), F.lit(step).alias("step"))
        frequent = written(frequent.unionByName(reached).groupBy(*keys).agg(F.max("n").alias("n"), F.min("step").alias("step")), f"frequent-{step}")
        parts = [*parts, part][-(shards - 1):] if shards > 1 else []
        step += 1
        bits = _bit_arrays(frequent, step - shards, size)
    return frequent.select(*keys, "n")


def collocations(found: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `per_lang` phrases of each language by how surely their parts go together.

    A phrase of two words or more is cut after each of its words; with a, l and r occurrences of it and its two parts a
    cut scores floor(2000000 a / (l + r)), and the lowest scoring cut counts (the earliest of equal ones). Phrases
    that mostly occur inside a longer one go. Order: score and a descending, phrase by its UTF-8 bytes.
    """
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    candidates = found.filter("size >= 2").select("lang", "size", "phrase", F.col("n").alias("a"))
    cut = candidates.select("lang", "size", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.withColumn("first", F.expr("substring_index(phrase, ' ', k)"))
    cut = cut.withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    part = lambda name, n: found.filter("size >= 1").select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cut = cut.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = cut.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("x"))
    inner = F.expr("""flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1),
        i -> array_join(slice(split(phrase, ' '), i, m), ' '))))""")
    covers = candidates.filter("size >= 3").select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    kept = lowest.join(covers, ["lang", "phrase"], "left").filter(
        F.col("cover").isNull() | (wide("cover") * 100 < wide("a") * COVERED)).select("lang", "phrase", "a", "x.*")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # A language's phrases are ranked in PARTS first, so that no task sees more than PARTS * per_lang of them at the end.
    parts = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        parts = parts.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= per_lang)
    top = parts.drop("part")
    words = found.filter("size = 0").select("lang", "n")
    return top.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
