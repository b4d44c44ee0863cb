"""Near-duplicate agent names within one office, and their merge.

Candidates come from a segment index, not from comparing all names of an office: if two
names are within `d` single-letter inserts and deletes, and the shorter one is cut into
`d + 1` pieces, then at least one piece occurs unchanged in the longer name, moved by no
more letters than there are inserts or deletes left. Only names that share such a piece
meet, and no pair is lost. A pair counts at the first piece it shares alone, so pairs need
no shuffle to become distinct, and leaves the join only if its letter counts (each insert
or delete changes one of them) and its edit distance stay within `d`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gableboard.functions.similarity import name_ratio
from gableboard.session import settled

EPS = 1e-9


def name_counts(transactions: DataFrame) -> DataFrame:
    """Distinct (name, office) with their number of rows."""
    return (
        transactions.filter(F.col("listing_agent").isNotNull())
        .groupBy(F.col("listing_agent").alias("name"), F.col("listing_office").alias("office"))
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def _budget(total: Column, threshold: float) -> Column:
    """Inserts plus deletes allowed for two names of `total` letters."""
    return F.floor(total * (1 - threshold / 100) + EPS).cast("int")


def _widest(length: Column, threshold: float) -> Column:
    """Longest partner of a name: longer - shorter may not exceed the budget."""
    share = 1 - threshold / 100
    return F.floor(length * (1 + share) / (1 - share) + EPS).cast("int")


def _pieces(length: Column, threshold: float) -> Column:
    """Number of pieces for names of this length: budget with the longest partner, plus 1."""
    return _budget(length + _widest(length, threshold), threshold) + 1


def _start(i: Column, length: Column, pieces: Column) -> Column:
    """Zero-based start of piece `i` of an even cut."""
    return F.floor(i * length / pieces).cast("int")


def _cut(i: Column, length: Column, pieces: Column) -> tuple[Column, Column]:
    """Start and length of piece `i`."""
    begin = _start(i, length, pieces)
    return begin, _start(i + 1, length, pieces) - begin


def _reach(begin: Column, size: Column, length: Column, longer: Column, threshold: float) -> tuple[Column, Column]:
    """First and last place in the longer name at which a kept piece of the shorter one may start.

    With `d` changes in all and `grow` more inserts than deletes, a kept piece moves left
    by at most the deletes and right by at most the inserts.
    """
    d, grow = _budget(longer + length, threshold), longer - length
    left, right = F.floor((d - grow) / 2).cast("int"), F.floor((d + grow) / 2).cast("int")
    return F.greatest(F.lit(0), begin - left), F.least(longer - size, begin + right)


def _letters(name: Column) -> Column:
    """64 bits: which of 32 classes of letters a name has, and has twice. An insert or delete changes one bit at most."""
    of = F.transform(F.split(name, ""), lambda c: F.pmod(F.ascii(c), F.lit(32)))
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("bigint"), x)
    return F.aggregate(of, F.lit(0).cast("bigint"), lambda a, x: a.bitwiseOR(
        F.when(a.bitwiseAND(bit(x)) == 0, bit(x)).otherwise(bit(x + 32))))


def _indexed(names: DataFrame, threshold: float) -> DataFrame:
    """Every piece of every name: the side searched for."""
    pieces = _pieces(F.col("len"), threshold)
    cut = names.withColumn("len", F.length("name"))
    cut = cut.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    begin, size = _cut(F.col("piece"), F.col("len"), pieces)
    return cut.withColumn("part", F.substring(F.col("name"), begin + 1, size))


def _probes(names: DataFrame, threshold: float) -> DataFrame:
    """Every substring of every name that could be a piece of a name no longer than it."""
    share = 1 - threshold / 100
    m = F.length("name")
    shortest = F.greatest(F.lit(1), F.ceil(m * (1 - share) / (1 + share) - EPS).cast("int"))
    out = names.withColumn("m", m).withColumn("len", F.explode(F.sequence(shortest, m)))
    out = out.withColumn("pieces", _pieces(F.col("len"), threshold))
    out = out.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    begin, size = _cut(F.col("piece"), F.col("len"), F.col("pieces"))
    out = out.withColumns({"begin": begin, "size": size})
    lo, hi = _reach(F.col("begin"), F.col("size"), F.col("len"), F.col("m"), threshold)
    grow = F.col("m") - F.col("len")
    out = out.withColumns({"lo": lo, "hi": hi}).filter(
        (grow <= _budget(F.col("m") + F.col("len"), threshold)) & (F.col("lo") <= F.col("hi")))
    parts = F.transform(F.sequence("lo", "hi"), lambda at: F.substring(F.col("name"), at + 1, F.col("size")))
    return out.select(*names.columns, "len", "piece", F.explode(F.array_distinct(parts)).alias("part"))


def _shared_before(threshold: float) -> Column:
    """Whether a pair shares a piece before this one."""
    short, long_ = F.length("l_name"), F.length("r_name")
    pieces = _pieces(short, threshold)

    def shared(k: Column) -> Column:
        begin, size = _cut(k, short, pieces)
        lo, hi = _reach(begin, size, short, long_, threshold)
        within = F.substring(F.col("r_name"), lo + 1, hi - lo + size)
        return (lo <= hi) & F.contains(within, F.substring(F.col("l_name"), begin + 1, size))

    earlier = F.filter(F.sequence(F.lit(0), F.col("l_piece")), lambda k: k < F.col("l_piece"))
    return F.exists(earlier, shared)


def candidates(counts: DataFrame, threshold: float = 90, *, within: bool = True) -> DataFrame:
    """Pairs of names of one office that share a piece, each once; `l_name` is not the longer one.

    `within` keeps those whose letter counts and edit distance allow the threshold.
    """
    keys = ["office", "len", "piece", "part"]
    names = counts.select("name", "office", "cnt", _letters(F.col("name")).alias("letters"))
    side = lambda df, mark: df.select(*[F.col(c).alias(f"{mark}_{c}") for c in (*keys, "name", "cnt", "letters")])
    left, right = side(_indexed(names, threshold), "l"), side(_probes(names, threshold), "r")
    match = F.equal_null("l_office", "r_office")
    for k in keys[1:]:
        match = match & (F.col(f"l_{k}") == F.col(f"r_{k}"))
    # Equal lengths meet in both directions; keep one.
    one_way = (F.length("l_name") < F.length("r_name")) | (
        (F.length("l_name") == F.length("r_name")) & (F.col("l_name") < F.col("r_name")))
    match = match & one_way
    if within:
        # In order of their cost. The edit distance never exceeds inserts plus deletes; -1 is beyond `allowed`.
        allowed = _budget(F.length("l_name") + F.length("r_name"), threshold)
        apart = F.bit_count(F.col("l_letters").bitwiseXOR(F.col("r_letters")))
        match = match & (apart <= allowed) & (F.call_function("levenshtein", F.col("l_name"), F.col("r_name"), allowed) >= 0)
    match = match & ~_shared_before(threshold)
    # Size estimates do not see the explosion into substrings, so a broadcast must not be
    # chosen from them; a sort-merge join also lets AQE split common pieces.
    return left.join(right.hint("merge"), match).select(
        F.col("l_office").alias("office"), "l_name", "l_cnt", "r_name", "r_cnt")


def edges(counts: DataFrame, threshold: float = 90) -> DataFrame:
    """Pairs of names of one office whose similarity reaches `threshold`.

    `a` is the more frequent one (then name order). A missing office is one office.
    """
    if not 0 < threshold <= 100:
        raise ValueError("threshold must be above 0 and at most 100")
    near = candidates(counts, threshold)
    # Out of a list of one, so that the filter is not pushed into the join, ahead of the cheap bounds.
    scored = near.withColumn("score", F.explode(F.array(name_ratio("l_name", "r_name")))).filter(F.col("score") >= threshold - EPS)
    l_first = (F.col("l_cnt") > F.col("r_cnt")) | (
        (F.col("l_cnt") == F.col("r_cnt")) & (F.col("l_name") < F.col("r_name")))
    pick = lambda a, b: F.when(l_first, F.col(a)).otherwise(F.col(b))
    return scored.select(
        "office", pick("l_name", "r_name").alias("a"), pick("l_cnt", "r_cnt").alias("a_cnt"),
        pick("r_name", "l_name").alias("b"), pick("r_cnt", "l_cnt").alias("b_cnt"), "score")


def _place(cnt: str, name: str, office: str) -> Column:
    """Sort key of a (name, office) row: most frequent first, then name, then office."""
    return F.struct((-F.col(cnt)).alias("c"), F.col(name).alias("n"), F.col(office).alias("o"))


def one_pass(counts: DataFrame, threshold: float = 90) -> DataFrame:
    """`(old_name, merged_into)` of one pass over the names.

    A row leads unless an earlier leading row of its office reaches its name. That depends
    on earlier rows only, so each round decides all rows whose rivals are decided.
    """
    pairs = settled(edges(counts, threshold).select(
        _place("a_cnt", "a", "office").alias("from_row"), "b",
        _place("b_cnt", "b", "office").alias("to_row")))
    # A name is merged by its first leading row, whichever office that row is in, and
    # then no later row of that name leads. Rivals of a row: rows that reach its name
    # from an earlier place.
    rows = counts.select(_place("cnt", "name", "office").alias("row"), F.col("name"))
    reached = pairs.select(F.col("b").alias("name"), F.col("from_row").alias("rival")).distinct()
    contests = settled(
        rows.join(reached, "name").filter(F.col("rival") < F.col("row")).select("row", "rival"))
    free = rows.join(contests.select("row").distinct(), "row", "left_anti").select("row")
    # Only rows that are somebody's rival matter as leaders.
    rivals = pairs.select(F.col("from_row").alias("row")).distinct()
    leading = settled(rivals.join(free, "row", "left_semi"))
    open_ = settled(contests.join(rivals, "row", "left_semi"))
    while not open_.isEmpty():
        beaten = open_.join(
            leading.withColumnRenamed("row", "rival"), "rival", "left_semi").select("row").distinct()
        undecided = open_.select(F.col("row").alias("rival")).distinct()
        left = open_.join(beaten, "row", "left_anti")
        # Of the rest, drop rivals that are decided and lost; a row without rivals leads.
        still = settled(left.join(undecided.join(
            beaten.withColumnRenamed("row", "rival"), "rival", "left_anti"), "rival", "left_semi"))
        won = left.select("row").distinct().join(still.select("row").distinct(), "row", "left_anti")
        leading = settled(leading.unionByName(won))
        open_ = still
    first = (
        pairs.join(leading.withColumnRenamed("row", "from_row"), "from_row", "left_semi")
        .groupBy(F.col("b").alias("old_name")).agg(F.min("from_row").alias("by"))
    )
    direct = settled(first.select("old_name", F.col("by.n").alias("merged_into")))
    return _followed(direct)


def _followed(direct: DataFrame) -> DataFrame:
    """Renames followed to their end by doubling; a merged name never leads again."""
    current = direct
    while True:
        step = current.select(F.col("old_name").alias("merged_into"), F.col("merged_into").alias("_next"))
        further = current.join(step, "merged_into", "left")
        if further.filter(F.col("_next").isNotNull()).isEmpty():
            return current
        current = settled(further.select(
            "old_name", F.coalesce("_next", "merged_into").alias("merged_into")))


def merge_names(transactions: DataFrame, threshold: float = 90) -> DataFrame:
    """All renames `(old_name, merged_into)` until no pass merges anything."""
    counts = settled(name_counts(transactions))
    total = None
    while True:
        renames = one_pass(counts, threshold)
        if renames.isEmpty():
            return total if total is not None else renames
        total = renames if total is None else settled(_chain(total, renames))
        renamed = counts.join(renames, counts["name"] == renames["old_name"], "left").select(
            F.coalesce("merged_into", "name").alias("name"), "office", "cnt")
        counts = settled(renamed.groupBy("name", "office").agg(F.sum("cnt").alias("cnt")))


def _chain(total: DataFrame, renames: DataFrame) -> DataFrame:
    """Earlier renames led on through the new ones, plus the new ones."""
    onward = renames.select(F.col("old_name").alias("merged_into"), F.col("merged_into").alias("_next"))
    moved = total.join(onward, "merged_into", "left").select(
        "old_name", F.coalesce("_next", "merged_into").alias("merged_into"))
    return moved.unionByName(renames.join(total.select("old_name"), "old_name", "left_anti"))


def apply_renames(transactions: DataFrame, renames: DataFrame) -> DataFrame:
    """`transactions` with merged listing agents.

    The renames hold one row per merged name; a hot agent name only repeats that row.
    """
    joined = transactions.join(
        renames, transactions["listing_agent"] == renames["old_name"], "left")
    return joined.withColumn(
        "listing_agent", F.coalesce("merged_into", "listing_agent")).drop("old_name", "merged_into")
