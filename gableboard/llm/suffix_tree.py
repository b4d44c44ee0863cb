"""Language-model scoring with a probabilistic suffix tree.

The model predicts a text token by token: words with A-Z folded, then the end. Its contexts are the last
bytes before a word, up to `depth`; its symbols are the end, the words seen LEAST times in training, and one
symbol for every other word. The counts come from all training texts. The tree grows from the empty context:
of the contexts one byte longer than a kept one, those are kept whose next-symbol distribution diverges enough
from the kept one's: count * KL(context || shorter), the bits it saves, must exceed COST bits for each symbol
seen in it. Neither bound knows the size of the corpus, so more text gives more symbols and more contexts. A
kept context's distribution is smoothed towards that of the kept one a byte shorter, (count + weight * that) /
(total + weight), and the empty one's towards the words' shares. The longest kept suffix of what came before a
token scores it; a word without a symbol of its own gets the other words' probability times its share
(count + 1) / (their tokens + their number + 1).

Words and tree are tables; they are joined, never collected. A pass over the texts for each length counts
pairs of context and symbol below the kept contexts only. Tasks know these by a bit for each possible context
(at most 2**24, so 2 MB; contexts of 4 bytes share bits) and the symbols by a bit array of 1 MB, where a wrong bit
sends a rare word along by its own hash, and the join that follows finds it out. Documents are dealt into blocks of
bounded size, row by row. A block asks for its distinct pairs, as the sorted hashes of a part of all hashes, of which
there are the more the more text there is; the part's answers come back in that order, without the hashes, and meet
the block's texts, where they are scored.

A null text is empty and consists of the end alone. Rows that repeat are scored one by one; a long text is
read in whole, and is one row of its block. Without training texts all counts are 0. An empty table gives an
empty result. Words are known by 64-bit hashes. Only the columns named are read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gableboard.llm import text_bytes as tb
from gableboard.llm.tables import written

DEPTH, WEIGHT = 4, 8.0
#: Training count from which a word is a symbol, and bits that a context must save for each symbol seen in it.
LEAST, COST = 16, 8.0
SPACE = 0x20
BLOCK_BYTES = 24 << 20
#: Bits of the array of symbols; rows that a task holds before it passes them on.
SYMBOL_BITS, HELD = 23, 1 << 20
#: Training tokens for each part of the keys of pairs, and a part's questions of a block (block, keys) or answers (keys, x).
PART, MESSAGE = 1 << 20, "part long, block long, keys binary, x binary"
#: Stands where a context does for the counts of words.
COUNT = -1
END_WORD, OTHER = (int(x) for x in tb.mix(np.array([0x5EED, 0x07E4], np.uint64)).view(np.int64))


def stream(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray):
    """Bytes of the texts as the tree sees them: a space, then each word with a space after it; the texts'
    offsets in them; the place of each word, and one more. starts, ends: the words; first: how many stand before each text."""
    lengths = ends - starts + 1
    texts = np.arange(len(first))
    begin = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=begin[1:])
    at = begin.copy()
    at[:-1] += np.repeat(texts[1:], np.diff(first))
    at[-1] += len(first) - 1
    out = np.full(at[-1], SPACE, np.uint8)
    inside = np.ones(begin[-1], bool)
    inside[begin[1:] - 1] = False
    inside = np.flatnonzero(inside)
    out[inside + np.repeat(at[:-1] - begin[:-1], lengths - 1)] = tb.FOLD[data[inside + np.repeat(starts - begin[:-1], lengths - 1)]]
    return out, begin[first] + texts, at


def tokens(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each token, the `depth` bytes before it (without the space next to it) as a number, and the
    texts' offsets in both."""
    starts, ends, first = tb.spans(data, offsets, tb.NOT_SPACE)
    symbols, at, places = stream(data, starts, ends, first)
    words = np.insert(tb.word_hashes(data, starts, ends).view(np.int64), first[1:], END_WORD)
    places = np.insert(places[:-1], first[1:], at[1:])
    begin = np.repeat(at[:-1], np.diff(first) + 1)
    code = np.zeros(len(places), np.int64)
    for back in range(depth + 1, 1, -1):
        code = (code << 8) | np.where(places - back >= begin, symbols[np.maximum(places - back, 0)], SPACE)
    return words, code, first + np.arange(len(first))


def pair_keys(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """A hash of each pair."""
    return tb.mix(tb.mix(context.astype(np.uint64)) + symbol.view(np.uint64))


def _bits(df: DataFrame, position: Column, size: int) -> np.ndarray:
    """A bit array of `size` bits, set at the positions found in df."""
    found = df.groupBy(F.shiftright(position, 15).alias("part")).agg(F.bitmap_construct_agg(position.bitwiseAND(F.lit(0x7FFF))).alias("bits"))
    out = np.zeros(max(size, 1 << 15) // 8, np.uint8)
    for r in found.collect():
        out[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out


def _has(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _frequent(token: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """OTHER for all words that are certainly no symbols."""
    return np.where(_has(bits, (token.view(np.uint64) >> np.uint64(64 - SYMBOL_BITS)).astype(np.int64)), token, OTHER)


def _below(code: np.ndarray, length: int) -> np.ndarray:
    return code & ((1 << 8 * length) - 1)


def _distinct(parts: list) -> list[np.ndarray]:
    """The distinct rows of `parts` (arrays of the columns, the last one a count), with their counts added up."""
    *keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    name = keys[0].view(np.uint64)
    for k in keys[1:]:
        name = pair_keys(name, k)
    if not len(name):
        return [*keys, n.astype(np.int64)]
    order = np.argsort(name)
    name = name[order]
    start = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    return [*(k[order[start]] for k in keys), np.add.reduceat(n[order], start).astype(np.int64)]


def _gathered(batches, take, names: list[str]):
    """The rows that `take` gives for each run of texts of a batch, distinct within HELD rows at least."""
    parts, held = [], 0
    for batch in batches:
        data, offsets = tb.utf8(batch.column("text"))
        for i, j in tb.groups(offsets, 2 * tb.CHUNK):
            part = _distinct([take(batch, data, offsets, i, j)])
            parts.append(part)
            held += len(part[0])
            if held > HELD:
                parts = [_distinct(parts)]
                held = len(parts[0][0])
                if held > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names)
                    parts, held = [], 0
    if parts:
        parts = parts if len(parts) == 1 else [_distinct(parts)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], names)


def _dealt(batches, block_bytes: int):
    """Each batch with the block of its rows: a task's rows in their order, cut after so many bytes."""
    start, size = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        _, offsets = tb.utf8(batch.column("text"))
        block = start + (size + offsets[:-1] - offsets[0]) // block_bytes
        size += int(offsets[-1] - offsets[0])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(block)], ["doc_id", "training", "text", "block"])


def _training(batch, i: int, j: int, first: np.ndarray) -> np.ndarray:
    """Whether each token of the texts i to j is learned from."""
    learn = batch.column("training").to_numpy(zero_copy_only=False).astype(bool)
    return np.repeat(learn[i:j], np.diff(first))


def _words(batch, data, offsets, i, j):
    token, _, first = tokens(data, offsets[i:j + 1])
    token = token[_training(batch, i, j, first)]
    return token, np.ones(len(token))


def grown(placed: DataFrame, symbols: DataFrame, frequent, level: DataFrame, total: int, depth: int = DEPTH, weight: float = WEIGHT,
          cost: float = COST) -> tuple[DataFrame, list[np.ndarray]]:
    """context (with its length above 32 bits), symbol, p of every pair that a text of `placed` may ask for, and the kept
    contexts of the lengths 1 to depth as bits. symbols: word; frequent: their bit array, as a broadcast; level: symbol,
    n, p in the empty context."""
    if not 2 <= depth <= 4:
        raise ValueError("contexts have 2 to 4 bytes")
    share = placed.sparkSession.sparkContext.broadcast
    short = lambda d: F.col("context").bitwiseAND(F.lit((1 << 8 * d) - 1))

    def counted(d: int, kept) -> DataFrame:
        def take(batch, data, offsets, i, j):
            token, code, first = tokens(data, offsets[i:j + 1])
            n = _training(batch, i, j, first).astype(float)
            if kept is not None:
                below = _has(kept.value, _below(code, d - 1))
                token, code, n = token[below], code[below], n[below]
            return _below(code, d), _frequent(token, frequent.value), n

        names = ["context", "word", "n"]
        met = placed.mapInArrow(lambda batches: _gathered(batches, take, names), "context long, word long, n long")
        # Added up where the join finds them, so that it sorts distinct pairs.
        met = met.repartition("word").groupBy("word", "context").agg(F.sum("n").alias("n"))
        own = met.join(symbols.select("word", F.col("word").alias("symbol")), "word", "left")
        return own.groupBy("context", F.coalesce("symbol", F.lit(OTHER)).alias("symbol")).agg(F.sum("n").alias("n"))

    level = level.select(F.lit(0).cast("long").alias("context"), "symbol", "n", F.lit(total).cast("long").alias("all"), "p")
    told, bits = [level], []
    pairs = written(counted(2, None), "followers")
    for d in range(1, depth + 1):
        if d == 1:
            own = pairs.groupBy(short(1).alias("context"), "symbol").agg(F.sum("n").alias("n"))
        else:
            own = pairs if d == 2 else counted(d, share(bits[-1]))
        above = level.select(F.col("context").alias("above"), "symbol", F.col("n").alias("m"), "all", "p")
        own = written(own.withColumn("above", short(d - 1)).join(above, ["above", "symbol"]).drop("above"), "suffixes")
        seen = F.col("n") > 0
        each = own.groupBy("context").agg(
            F.sum(F.when(seen, F.col("n") * F.log2(F.col("n") / F.col("m"))).otherwise(0.0)).alias("s"), F.sum("n").alias("c"),
            F.count(F.when(seen, True)).alias("k"), F.max("all").alias("above_all"))
        saves = F.col("s") + F.col("c") * F.log2(F.col("above_all") / F.col("c")) > cost * F.col("k")
        each = written(each.select("context", "c", ((F.col("c") > 0) & F.coalesce(saves, F.lit(False))).alias("kept")), "contexts")
        bits.append(_bits(each.filter("kept"), _place(F.col("context"), d), 1 << min(8 * d, 24)))
        if d < depth:  # a text asks for kept contexts only; of 4 bytes for those that share a bit with a kept one, too
            each = each.filter("kept")
        if d <= 2:  # at most 65,536 contexts
            each = F.broadcast(each)
        level = own.join(each, "context").select(
            "context", "symbol", "n", F.col("c").alias("all"),
            F.when(F.col("kept"), (F.col("n") + weight * F.col("p")) / (F.col("c") + weight)).otherwise(F.col("p")).alias("p"))
        told.append(level)
    key = lambda d: (F.col("context") + F.lit(d << 32)).alias("context")
    return reduce(DataFrame.union, (x.select(key(d), "symbol", "p") for d, x in enumerate(told))), bits


def _place(context, length: int):
    """The bit of a context: a number of 24 bits at most, so one of 4 bytes shares it with others."""
    if length < 4:
        return context
    if isinstance(context, Column):
        return context.bitwiseXOR(F.shiftright(context, 8)).bitwiseAND(F.lit(0xFFFFFF))
    return (context ^ (context >> 8)) & 0xFFFFFF


def _longest(code: np.ndarray, bits: list[np.ndarray]) -> np.ndarray:
    """What each token asks for: its longest kept context, or one of 4 bytes that shares a bit with a kept one."""
    asked = np.zeros(len(code), np.int64)
    kept = np.ones(len(code), bool)
    for d, known in enumerate(bits, 1):
        own = _below(code, d)
        kept &= _has(known, _place(own, d))
        asked = np.where(kept, own + (d << 32), asked)
    return asked


def _union(keys: list[np.ndarray]) -> np.ndarray:
    return tb.distinct(np.concatenate(keys)) if keys else np.zeros(0, np.uint64)


def _questions(token: np.ndarray, context: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The sorted keys of what the tokens ask for: the words in their contexts, the rare words' probability in each context,
    and of each word its count, as if it stood in a context of its own kind."""
    contexts, words = tb.distinct(context), tb.distinct(token)
    return _union([pair_keys(context, _frequent(token, frequent)), pair_keys(contexts, np.full(len(contexts), OTHER)),
                   pair_keys(np.full(len(words), COUNT), words)])


def _cut(keys: np.ndarray, parts: int):
    """The part of sorted keys, and where it starts and ends, for each part that has any."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    return zip(part[start].tolist(), start.tolist(), [*start[1:].tolist(), len(part)], strict=False)


def _message(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()),
                                                                      strict=True)], ["part", "block", "keys", "x"])


def _asked(batches, parts: int, known: list[np.ndarray], frequent: np.ndarray):
    """The questions of each block, by parts of all keys."""

    def sent(block, asked):
        keys = _union(asked)
        return _message([(part, block, keys[a:b].tobytes(), None) for part, a, b in _cut(keys, parts)])

    block, asked = None, []
    for batch in batches:
        data, offsets = tb.utf8(batch.column("text"))
        of = batch.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if start == end:
                continue
            if block is not None and of[start] != block:
                yield sent(block, asked)
                asked = []
            block = int(of[start])
            for i, j in tb.groups(offsets[start:end + 1], 2 * tb.CHUNK):
                token, code, _ = tokens(data, offsets[start + i:start + j + 1])
                asked.append(_questions(token, _longest(code, known), frequent))
            if len(asked) > 8:
                asked = [_union(asked)]
    if asked:
        yield sent(block, asked)


def _answers(batches, parts: int, known: list[np.ndarray]):
    """Rows of context, symbol, p as the keys of their pairs and p, by parts of all keys; those without a bit go."""
    depth = len(known)
    held, size = [], 0

    def sent():
        keys, x = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.argsort(keys)
        keys, x = keys[order], x[order]
        return _message([(part, None, keys[a:b].tobytes(), x[a:b].tobytes()) for part, a, b in _cut(keys, parts)])

    for batch in batches:
        context, symbol, x = (c.to_numpy() for c in batch.columns)
        asked = np.flatnonzero((context >> 32 != depth) | _has(known[-1], _place(_below(context, depth), depth)))
        held.append((pair_keys(context[asked], symbol[asked]), x[asked]))
        size += len(asked)
        if size > HELD:
            yield sent()
            held, size = [], 0
    if size:
        yield sent()


def _told(table: pa.Table) -> pa.Table:
    """The answers to each block's questions of a part, in the order of the keys; 0 where there is none."""
    part = table.column("part")[0].as_py()
    blocks: dict = {}
    keys, x = [np.zeros(0, np.uint64)], [np.zeros(0)]
    for block, k, y in zip(*(table.column(c).to_pylist() for c in ("block", "keys", "x")), strict=True):
        if block is None:
            keys.append(np.frombuffer(k, np.uint64))
            x.append(np.frombuffer(y, float))
        else:
            blocks.setdefault(block, []).append(np.frombuffer(k, np.uint64))
    keys, x = np.concatenate(keys), np.concatenate(x)
    order = np.argsort(keys)
    keys, x = np.append(keys[order], np.uint64(0)), np.append(x[order], 0.0)
    out = []
    for asked in blocks.values():
        asked = _union(asked)
        at = np.searchsorted(keys[:-1], asked)
        out.append(np.where(keys[at] == asked, x[at], 0.0).tobytes())
    return pa.table([pa.array(blocks, pa.int64()), pa.array([part] * len(out), pa.int64()), pa.array(out, pa.binary())],
                    names=["block", "part", "x"])


def score(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES,
          depth: int = DEPTH, weight: float = WEIGHT, cost: float = COST) -> DataFrame:
    """doc_id, training, n_tokens, n_known, train_tokens, base_score, score for every row of docs; rows with
    `training` true are learned from."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(training, F.lit(False)).alias("training"), F.col(text).alias("text"))
    # Written, so that a lost task finds each row in its block again.
    placed = docs.mapInArrow(lambda batches: _dealt(batches, block_bytes), "doc_id long, training boolean, text string, block long")
    placed = written(placed, "blocks", "zstd")

    words = placed.mapInArrow(lambda batches: _gathered(batches, _words, ["word", "n"]), "word long, n long")
    words = written(words.groupBy("word").agg(F.sum("n").alias("c")), "words")
    is_end, is_symbol = F.col("word") == END_WORD, (F.col("c") >= LEAST) | (F.col("word") == END_WORD)
    n, v, rest, ends, other = (x or 0 for x in words.agg(
        F.sum("c"), F.count("c"), F.sum(F.when(~is_symbol, F.col("c") + 1)), F.sum(F.when(is_end, F.col("c"))),
        F.sum(F.when(~is_symbol, F.col("c")))).first())
    rest += 1
    fixed = spark.createDataFrame([(END_WORD, ends), (OTHER, other)], "symbol long, n long")
    # Without training, the end and the others share all.
    part = F.when(F.col("symbol") == OTHER, F.lit(rest)).otherwise(F.col("n") + 1) / F.lit(n + v + 1 + (n == 0))
    level = words.filter(is_symbol & ~is_end).select(F.col("word").alias("symbol"), F.col("c").alias("n")).union(fixed)
    level = level.withColumn("p", (F.col("n") + weight * part) / F.lit(n + weight))
    symbols = words.filter(is_symbol).select("word").union(spark.createDataFrame([(END_WORD,)], "word long")).distinct()
    symbols = written(symbols, "symbols")  # so that Spark knows its size before it plans a join
    frequent = spark.sparkContext.broadcast(_bits(symbols, F.shiftrightunsigned("word", 64 - SYMBOL_BITS), 1 << SYMBOL_BITS))
    tree, bits = grown(placed, symbols, frequent, level, n, depth, weight, cost)
    known = spark.sparkContext.broadcast(bits)

    parts = 1
    while parts * PART < n:
        parts *= 2
    asked = placed.mapInArrow(lambda batches: _asked(batches, parts, known.value, frequent.value), MESSAGE)
    answers = tree.union(words.select(F.lit(COUNT).cast("long"), "word", F.col("c").cast("double")))
    answers = answers.mapInArrow(lambda batches: _answers(batches, parts, known.value), MESSAGE)
    # Written, so that the shuffle of the questions is gone before texts travel.
    told = written(asked.union(answers).groupBy("part").applyInArrow(_told, "block long, part long, x binary"), "told")
    names = ["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def scored(table: pa.Table, told: pa.Table) -> pa.Table:
        # The parts' answers one after another are those to the block's questions in their order.
        x = told.sort_by("part").column("x")
        x = np.frombuffer(b"".join(x.to_pylist()), float)
        data, offsets = tb.utf8(table.column("text"))
        runs = [(i, j, *tokens(data, offsets[i:j + 1])) for i, j in tb.groups(offsets)]
        runs = [(i, j, token, _longest(code, known.value), first) for i, j, token, code, first in runs]
        questions = _union([_questions(token, context, frequent.value) for _, _, token, context, _ in runs])

        def found(context, symbol):
            wanted = pair_keys(context, symbol)
            order = np.argsort(wanted)  # in order, they are found much faster
            out = np.empty(len(wanted))
            out[order] = x[np.searchsorted(questions, wanted[order])]
            return out

        tokens_of, met, base, model = (np.zeros(len(offsets) - 1, k) for k in (np.int64, np.int64, float, float))
        for i, j, token, context, first in runs:
            c = found(np.full(len(token), COUNT), token)
            own = (c >= LEAST) | (token == END_WORD)
            share = found(context, np.where(own, token, OTHER))
            sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[first])
            tokens_of[i:j], met[i:j] = np.diff(first), sums(c > 0)
            base[i:j] = sums(np.log10(c + 1.0)) - np.diff(first) * math.log10(n + v + 1)
            model[i:j] = sums(np.log10(share) + np.where(own, 0, np.log10((c + 1.0) / rest)))
        return pa.table([table.column("doc_id"), table.column("training"), pa.array(tokens_of), pa.array(met),
                         pa.array(np.full(len(met), n, np.int64)), pa.array(base), pa.array(model)], names=names)

    schema = "doc_id long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return placed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(scored, schema)
