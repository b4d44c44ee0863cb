"""N-gram Jaccard join: documents whose shingle sets have a Jaccard similarity of at least t, exactly.

A set is the distinct k-word shingles of a whole text (all its words as one shingle where it has fewer).
Texts with equal sets form one node. The join of nodes goes through four steps, all exact together:

1. Keys. Of two sets with similarity >= t, the first n - ceil(t n) + 1 shingles of each, in one order of
   all shingles, have a member in common. The order puts shingles that very many sets share last, so that
   a common passage is no key unless a set holds little else; among the others it follows the hash.
2. Stars. Within a key only pairs with the key's first node (by a random priority) are looked at, one
   per node, however many share the key. In keys with nodes left apart, its next few nodes get stars too.
3. Checks. A pair passes the ratio of sizes, then an upper bound of the overlap from bitmaps of hashed
   shingles (|A and B| <= |A| - |bits of A only|), then the exact intersection of the sorted arrays.
4. Tiles. A key all of whose nodes are connected by now is done, and so is one with no more nodes than
   the stars have paired with each other. In the others, nodes are sorted by size
   and cut into tiles of bounded size; pairs of tiles whose sizes allow a link are compared by bitmaps,
   only across different components, and what is left is checked as in step 3. Keys of few nodes do with the
   bitmaps of step 3, where a node leaves few pairs however near they are; wide ones are made for the others.

So no group's pairs are all made, while every link is either checked or joins nodes that are connected
already: the components equal those of all links. Bitmaps have at least one bit per shingle, wide ones eight, rounded
up to a power of two (a size band); the wider of two is folded onto the other.

A null text, or one without words, has no set and is linked with nothing: its component is its own id.
Equal rows, and rows that share an id, are documents of their own. Null ids are kept; a component's id is
the smallest id that is not null, if any. Shingles and sets are known by 64-bit hashes.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gableboard.llm import text_bytes as tb
from gableboard.llm.components import components, joined
from gableboard.llm.tables import packed, written

WORDS, PERCENT = 5, 75
#: Shingles counted at once in a task, and the count from which a shingle is reported.
WINDOW, OFTEN = 1 << 21, 8
#: A shingle is common if it has more than this share of all shingles; so at most 1/share are.
SHARE = 1 / (1 << 20)
#: Bits of the filter that tells which sets are needed; a full filter only costs time.
FILTER_BITS = 1 << 23
TILE = 1024
#: Bits a shingle of the bitmaps that travel with pairs, and of those that tiles of keys with more than FEW nodes compare.
NARROW, WIDE, FEW = 1, 8, 128
#: 64-bit words of bitmaps that are compared at once.
COMPARED = 1 << 18
#: Stars in the second round, around the second and further nodes of a key; each takes the nodes after it.
STARS = 4
_C1, _C2 = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25)


def sets(column, k: int):
    """A hash of each text's set, None if it is empty, and the sorted array of its shingle hashes."""
    data, offsets = tb.utf8(column)
    for i, j in tb.groups(offsets):
        starts, ends, first = tb.spans(data, offsets[i:j + 1], tb.NOT_SPACE)
        words = tb.word_hashes(data, starts, ends)
        shingles = tb.shingle_hashes(words, k)
        found = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= k:
                found.append(tb.distinct(shingles[a:b - k + 1]))
            else:
                found.append(tb.shingle_hashes(words[a:b], int(b - a)) if b > a else words[:0])
        yield from zip(nodes_of(found), found, strict=True)


def nodes_of(found: list[np.ndarray]) -> list[int | None]:
    """A hash of each set, None of an empty one."""
    n = np.array([len(s) for s in found], np.int64)
    filled = np.flatnonzero(n)
    out = np.full(len(n), None)
    if len(filled):
        sums = np.add.reduceat(tb.mix(np.concatenate(found) ^ _C1), (np.cumsum(n) - n)[filled])
        out[filled] = tb.mix(sums + n[filled].astype(np.uint64) * _C2).view(np.int64).tolist()
    return out.tolist()


def bitmap(shingles: np.ndarray, share: int = NARROW, most: int = 1 << 15) -> bytes:
    """Hashed shingles in `share` bits each, rounded up to a power of two."""
    width = 64
    while width < share * len(shingles) and width < most:
        width *= 2
    bits = np.zeros(width, bool)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def wide(shingles: np.ndarray) -> bytes:
    """For tiles of many nodes, where all pairs of a group meet and most are just too far apart."""
    return bitmap(shingles, WIDE, 1 << 17)


def views(column: pa.Array) -> list[np.ndarray]:
    """The 64-bit words of each value of a binary column, without copies."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset)
    words = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return [words[a:b].view(np.uint64) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def fold(words: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (last axis) folded to `width` 64-bit words."""
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All 64-bit words of a binary column, where each value starts in them, and how many words it has."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    words = np.frombuffer(data, np.uint8)[at[0]:at[-1]].view(np.uint64) if at[-1] > at[0] else np.zeros(0, np.uint64)
    return words, (at[:-1] - at[0]) // 8, np.diff(at) // 8


def may_link(n: np.ndarray, m: np.ndarray, a: pa.Array, b: pa.Array, percent: int) -> np.ndarray:
    """Whether sets of n and m shingles with the bitmaps a and b may be linked, for each row."""
    keep = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    (x, at_x, wide_x), (y, at_y, wide_y) = _matrix(a), _matrix(b)
    rows = np.flatnonzero(keep)
    rows = rows[np.lexsort((wide_y[rows], wide_x[rows]))]
    # Rows of equal widths are compared together.
    for part in np.split(rows, np.flatnonzero((np.diff(wide_x[rows]) != 0) | (np.diff(wide_y[rows]) != 0)) + 1):
        if not len(part):
            continue
        v, w = int(wide_x[part[0]]), int(wide_y[part[0]])
        step = max(1, COMPARED // max(v, w))
        for i in range(0, len(part), step):
            r = part[i:i + step]
            p = fold(x[at_x[r][:, None] + np.arange(v)], min(v, w))
            q = fold(y[at_y[r][:, None] + np.arange(w)], min(v, w))
            most = np.minimum(n[r] - np.bitwise_count(p & ~q).sum(axis=1, dtype=np.int64),
                              m[r] - np.bitwise_count(q & ~p).sum(axis=1, dtype=np.int64))
            keep[r] = (100 + percent) * most >= percent * (n[r] + m[r])
    return keep


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _described(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, h, n, node, sig of every row; and rows of shingle, times for shingles often met in a task."""

    def run(batches):
        seen, held, size = set(), [], 0

        def often():
            found, times = np.unique(np.concatenate(held), return_counts=True)
            many = times >= OFTEN
            found, times = found[many], times[many]
            nothing = lambda kind: pa.nulls(len(found), kind)
            return pa.RecordBatch.from_arrays(
                [nothing(pa.int64()), nothing(pa.int64()), nothing(pa.int64()), nothing(pa.int64()), nothing(pa.binary()),
                 pa.array(_signed(found)), pa.array(times.astype(np.int64))], names)

        names = ["doc_id", "h", "n", "node", "sig", "shingle", "times"]
        for batch in batches:
            n, nodes, sigs = [], [], []
            for node, s in sets(batch.column(1), k):
                n.append(len(s))
                nodes.append(node)
                if node is not None and node not in seen:
                    seen.add(node)
                    held.append(s)
                    size += len(s)
                    sigs.append(bitmap(s))
                else:
                    sigs.append(None)
                if size >= WINDOW:
                    yield often()
                    held, size = [], 0
            rows = len(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary()),
                 pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())], names)
        if held:
            yield often()

    return docs.mapInArrow(run, "doc_id long, h long, n long, node long, sig binary, shingle long, times long")


def _keys(docs: DataFrame, k: int, percent: int, common) -> DataFrame:
    """key, node, n: the keys of each node, once per task that meets it."""

    def run(batches):
        seen = set()
        last, order = common.value
        for batch in batches:
            keys, nodes, sizes = [], [], []
            for node, s in sets(batch.column(1), k):
                if node is None or node in seen:
                    continue
                seen.add(node)
                n = len(s)
                p = n + percent * n // -100 + 1
                if len(last):
                    at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                    is_last = last[at] == s
                    rare = s[~is_last][:p]
                    if len(rare) < p:
                        rest, rank = s[is_last], order[at[is_last]]
                        rare = np.concatenate([rare, rest[np.argsort(rank)][:p - len(rare)]])
                    keys.append(rare)
                else:
                    keys.append(s[:p])
                nodes.append(node)
                sizes.append(n)
            times = [len(x) for x in keys]
            flat = _signed(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat), pa.array(np.repeat(np.array(nodes, np.int64), times)),
                 pa.array(np.repeat(np.array(sizes, np.int64), times))], ["key", "node", "n"])

    return docs.mapInArrow(run, "key long, node long, n long")


def _needed_sets(docs: DataFrame, k: int, nodes: DataFrame, made=np.ndarray.tobytes) -> DataFrame:
    """node, shingles (sorted 64-bit hashes, or what is made of them) of the given nodes."""
    position = F.col("node").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = (nodes.select(F.shiftright(position, 6).alias("w"), F.expr(f"shiftleft(1L, int((node & {FILTER_BITS - 1}) & 63))").alias("m"))
             .groupBy("w").agg(F.bit_or("m").alias("m")).toArrow())
    filter_words = np.zeros(FILTER_BITS // 64, np.int64)
    filter_words[words.column("w").to_numpy()] = words.column("m").to_numpy()
    wanted = docs.sparkSession.sparkContext.broadcast(filter_words.view(np.uint64))

    def run(batches):
        seen = set()
        for batch in batches:
            found, arrays = [], []
            for node, s in sets(batch.column(1), k):
                if node is None or node in seen:
                    continue
                at = node & (FILTER_BITS - 1)
                if int(wanted.value[at >> 6]) >> (at & 63) & 1:
                    seen.add(node)
                    found.append(node)
                    arrays.append(made(s))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(arrays, pa.binary())],
                                             ["node", "shingles"])

    return docs.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"])


def _checked(docs: DataFrame, k: int, percent: int, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b: the pairs (a, b) of nodes that are links."""

    def near(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in (2, 3))
            keep = may_link(n, m, batch.column(4), batch.column(5), percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def linked(batches):
        for batch in batches:
            keep = []
            for x, y in zip(views(batch.column(2)), views(batch.column(3)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append((100 + percent) * both >= percent * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(df, name, column):
        return df.select(F.col("node").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in column))

    bounded = (pairs.join(side(nodes, "a", ["n", "sig"]), "a").join(side(nodes, "b", ["n", "sig"]), "b")
               .select("a", "b", "n_a", "n_b", "sig_a", "sig_b").mapInArrow(near, "a long, b long"))
    bounded = written(bounded, "pairs")
    ids = bounded.select(F.col("a").alias("node")).union(bounded.select("b"))
    # Written, as both joins would read the texts otherwise.
    known = written(_needed_sets(docs, k, ids).withColumnRenamed("shingles", "s"), "sets")
    both = bounded.join(side(known, "a", ["s"]), "a").join(side(known, "b", ["s"]), "b")
    return both.select("a", "b", "s_a", "s_b").mapInArrow(linked, "a long, b long")


def _distinct_groups(rows: DataFrame) -> DataFrame:
    """key, node without the keys whose nodes are those of another key (by count and two sums of hashes)."""
    groups = rows.groupBy("key").agg(F.count("*").alias("c"), F.sum(F.xxhash64("node") % (1 << 31)).alias("x"),
                                     F.sum(F.xxhash64("node", F.lit(1)) % (1 << 31)).alias("y"))
    return rows.join(groups.groupBy("c", "x", "y").agg(F.min("key").alias("key")).select("key"), "key", "left_semi")


def _tiled_pairs(rows: DataFrame, docs: DataFrame, k: int, percent: int, nodes: DataFrame) -> DataFrame:
    """a, b: pairs within a key, of different roots, that sizes and bitmaps leave possible.

    rows: key, node, n, root, c (the key's nodes)."""
    signed = nodes.select("node", "sig", F.lit(False).alias("many"))
    many = rows.filter(F.col("c") > FEW).select("node")
    if not many.isEmpty():
        made = written(_needed_sets(docs, k, many, wide).withColumnRenamed("shingles", "sig"), "wide")
        signed = signed.union(made.withColumn("many", F.lit(True)))
    own = rows.groupBy("node").agg(F.collect_set("key").alias("keys"))  # no more than a node's prefix
    place = F.row_number().over(W.partitionBy("key").orderBy("n", "node"))
    cut = written(rows.withColumn("tile", F.floor((place - 1) / TILE).cast("int")), "tiles")
    tiles = cut.groupBy("key", "tile").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    left = tiles.select("key", F.col("tile").alias("i"), F.col("hi").alias("hi_i"))
    right = tiles.select("key", F.col("tile").alias("j"), F.col("lo").alias("lo_j"))
    squares = left.join(right, "key").filter(f"i <= j and 100 * hi_i >= {percent} * lo_j").select("key", "i", "j")
    left = cut.join(squares.withColumn("tile", F.col("i")), ["key", "tile"]).withColumn("second", F.lit(False))
    right = cut.join(squares.filter("i < j").withColumn("tile", F.col("j")), ["key", "tile"]).withColumn("second", F.lit(True))
    columns = ["key", "i", "j", "n", "node", "root", "second"]
    kind = (F.col("c") > FEW).alias("many")
    placed = left.select(*columns, kind).union(right.select(*columns, kind)).join(signed, ["node", "many"]).join(own, "node")
    # A pair is made at the smallest key that its nodes share: `before` are a node's smaller ones.
    placed = placed.withColumn("before", F.filter("keys", lambda k: k < F.col("key")))
    placed = placed.select(*columns[:-1], "sig", "before", "second").repartition("key", "i", "j").sortWithinPartitions(
        "key", "i", "j", "n", "node")

    def pairs(found):
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in found], pa.int64()),
                                           pa.array([p[1] for p in found], pa.int64())], ["a", "b"])

    def run(batches):
        stream = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        found = []
        for (_, i, j), group in groupby(stream, key=lambda r: r[:3]):
            _, _, _, n, node, root, sig, before, second = zip(*group, strict=True)
            before = [frozenset(x) for x in before]
            n, root, second = np.array(n), np.array(root), np.array(second)
            words = [np.frombuffer(x, np.uint64) for x in sig]
            widths = np.array([len(w) for w in words])
            tables: dict[int, np.ndarray] = {}
            for x in range(len(n)):
                if second[x]:
                    continue
                hi = int(np.searchsorted(n, 100 * n[x] // percent, "right"))
                other = np.arange(x + 1, hi)
                other = other[root[other] != root[x]]
                if i < j:
                    other = other[second[other]]
                if not len(other):
                    continue
                w = int(widths[x])
                if w not in tables:
                    tables[w] = np.zeros((len(n), w), np.uint64)
                    for y in np.flatnonzero(widths >= w):
                        tables[w][y] = fold(words[y], w)
                own, rest = tables[w][x], tables[w][other]
                most = np.minimum(n[x] - np.bitwise_count(own & ~rest).sum(axis=1, dtype=np.int64),
                                  n[other] - np.bitwise_count(rest & ~own).sum(axis=1, dtype=np.int64))
                for y in other[(100 + percent) * most >= percent * (n[x] + n[other])]:
                    if before[x].isdisjoint(before[y]):
                        found.append((min(node[x], node[y]), max(node[x], node[y])))
            if len(found) > 10_000:
                yield pairs(found)
                found = []
        yield pairs(found)

    return placed.mapInArrow(run, "a long, b long").distinct()


def _rooted(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, h, n, node, root (of the node's component) for every row of docs (doc_id, text, h); null without words."""
    spark = docs.sparkSession
    described = written(_described(docs.select("doc_id", "text", "h"), k), "described")
    docs = docs.select("doc_id", "text")
    members = described.filter("n is not null").select("doc_id", "h", "n", "node")
    # A task gives a node's bitmap once.
    nodes = written(described.filter("sig is not null").groupBy("node").agg(
        F.first("n").alias("n"), F.first("sig").alias("sig")), "nodes")
    total = nodes.agg(F.sum("n")).first()[0] or 0
    often = described.filter("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("times"))
    often = often.filter(F.col("times") >= max(OFTEN, total * SHARE)).toArrow()
    shingle = often.column("shingle").to_numpy().view(np.uint64)
    rank = np.empty(len(shingle), np.int64)
    rank[np.lexsort((shingle, often.column("times").to_numpy()))] = np.arange(len(shingle))
    by_hash = np.argsort(shingle)
    common = spark.sparkContext.broadcast((shingle[by_hash], rank[by_hash]))

    def sizes_fit(n, m):
        return 100 * F.least(n, m) >= percent * F.greatest(n, m)

    sizes = nodes.select("node", "n")
    # The ordered windows stream: no key's rows are held together.
    first = W.partitionBy("key").orderBy(F.xxhash64("node", F.lit(0)), "node")
    # The order is worked out after the shuffle, so that keys travel as two numbers.
    rows = _keys(docs, k, percent, common).select("key", "node").repartition("key")
    shared = written(rows.withColumn("hub", F.first("node").over(first)).filter("hub != node")
                     .select("key", "hub", "node").distinct(), "shared")
    pairs = written(shared.select("hub", "node").distinct(), "stars")
    near = pairs.join(sizes, "node").join(sizes.toDF("hub", "hub_n"), "hub").filter(sizes_fit(F.col("hub_n"), F.col("n")))
    near = near.select(F.col("hub").alias("a"), F.col("node").alias("b"))
    roots = written(components(_checked(docs, k, percent, near, nodes)), "roots")

    def rooted(df, node="node", root="root"):
        known = roots.select(F.col("node").alias(node), F.col("root").alias(root))
        return df.join(known, node, "left").withColumn(root, F.coalesce(root, node))

    # Keys with nodes apart; with one node beside its hub, a key's only pair has been checked.
    apart = rooted(rooted(pairs), "hub", "hub_root").filter("root != hub_root").select("hub", "node", F.lit(1).alias("apart"))
    keys = (shared.join(apart, ["hub", "node"], "left").groupBy("key")
            .agg(F.count("*").alias("c"), F.max("apart").alias("apart")).filter("c > 1 and apart = 1").select("key"))
    rest = shared.join(keys, "key", "left_semi")
    opened = written(rest.select("key", "node").union(rest.select("key", "hub")).distinct(), "open")
    opened = written(rooted(_distinct_groups(opened).join(sizes, "node")), "open")
    if not opened.isEmpty():
        # A row sees only the centres that come before it in its key, so a pair is made once a key.
        centre = F.struct("node", "n", "root")
        centres = [F.nth_value(centre, turn + 1).over(first) for turn in range(1, STARS + 1)]
        again = opened.withColumn("centres", F.array(*centres))
        again = again.withColumn("centre", F.explode(F.filter(
            "centres", lambda c: c.isNotNull() & (c["root"] != F.col("root")) & sizes_fit(c["n"], F.col("n")))))
        again = again.select(F.least("centre.node", "node").alias("a"), F.greatest("centre.node", "node").alias("b"))
        again = written(again.distinct(), "stars")
        roots = written(joined(roots, _checked(docs, k, percent, again, nodes)), "roots")
        opened = rooted(opened.drop("root"))
        mixed = (opened.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("c"))
                 .filter(f"lo != hi and c > {STARS + 2}").select("key", "c"))
        mixed = written(opened.join(mixed, "key"), "mixed")
        pairs = mixed.select("node", "node") if mixed.isEmpty() else written(_tiled_pairs(mixed, docs, k, percent, nodes), "tiled")
        if not pairs.isEmpty():
            roots = written(joined(roots, _checked(docs, k, percent, pairs, nodes)), "roots")

    alone = members.filter("node is null").withColumn("root", F.lit(None).cast("long"))
    return rooted(members.filter("node is not null")).select(*alone.columns).union(alone)


def join(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.lit(0).cast("long").alias("h"))
    members = _rooted(docs, k, percent)
    placed = members.filter("root is not null")
    ids = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = placed.join(ids, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = members.filter("root is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return found.union(alone)


def one_of_each(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of docs for each component: that of the smallest id, a null one being the largest, then of the
    smallest hash. Rows that share an id, or have none, are rows of their own; those without words all stay."""
    # A row is known by its hash and its id; the hash tells a null id from 0.
    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))
    rows = docs.select(packed(docs), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("h"), known.alias("k"), "doc_id", "text")
    members = _rooted(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "h"), k, percent)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "h")).alias("least")
    kept = members.filter("root is not null").groupBy("root").agg(least).select(
        F.col("least.h").alias("h"), F.coalesce("least.doc_id", F.lit(0).cast("long")).alias("k"))
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    chosen = rows.filter(has_words).join(kept, ["h", "k"], "left_semi")
    # Equal rows are one row.
    chosen = chosen.withColumn("nth", F.row_number().over(W.partitionBy("h", "k").orderBy("h"))).filter("nth = 1")
    return chosen.select("row.*").union(docs.filter(~has_words))
