"""Repair of conversations by aligning their turns to an alternating grammar.

A conversation's rows are taken by turn (nulls first; rows of one turn by role and text). The first fault of a row
counts: blank (nothing but white space), duplicate (role and text of an earlier row), truncated (the last
character that is no white space is not one of . ! ?). A repair is a sequence of edits that leaves the role
initials `(s?(ua)+)?`:

    K keep 0          R give the other of the roles user and assistant 1      D delete 2 (a must for blank, duplicate)
    I insert an empty user or assistant turn 5            a truncated row that is not deleted adds 5

Method: for a target length the grammar string is fixed, and Wagner-Fischer aligns the rows to it. The strings of
all feasible lengths are suffixes of one another (but for the leading s), so one table indexed by (row, letters
still to come) holds the alignments to all of them. Only cells that a repair no dearer than the incumbent can
use are filled (Ukkonen's band): if r letters are to come and the rows to come hold g that may stay, t of them
truncated, then g - r deletions or r - g insertions remain, which bounds the cost from below. The incumbent is
the cheapest repair found in a band; the band is widened until it covers all that its cost allows. Among the
cheapest repairs of all lengths the one whose audit (initials of the edits) is the least string is traced back,
the tied lengths letter by letter together.

At scale: rows are put in order by a range sort, so the rows of a long conversation lie in many tasks; only one
character of a row (role and fault) is gathered by conversation, in chunks, for its alignment, whose result is
a string of that length. Texts are shuffled by conversation once more, streamed in order beside the audit and never held
together. Time is rows x band; of the table every 512th line is kept and the lines between are filled again for
the trace, so memory is (rows / 512 + 512) x band.

Null roles and texts are read as one space, a null conv_id is a conversation. Repeated rows are duplicates. A
role is judged by its first character, which is compared as it stands. An empty table gives empty results.
Only conv_id, turn, role and text are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gableboard.llm.tables import written

#: Costs of the edits; KEEP costs nothing, CUT is added for a truncated row that stays.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
FIRST_BAND = 12
#: Lines of the table between two that are kept.
LINES = 512
#: Rows of a conversation gathered in one string before its strings are put together: 2**CHUNK.
CHUNK = 12
INFINITE = 1 << 60
ROLES = {"u": "user", "a": "assistant"}
WHITE = " \t\n\x0b\x0c\r"
AUDITS = "conv_id {}, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
BATCH = 1 << 20


def _in_order(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"))


def _codes(turns: DataFrame) -> DataFrame:
    """conv_id, codes: a hexadecimal digit of each row in order, role (s, u, a, other) + 4 * fault (none, blank, duplicate, truncated)."""
    spoken = F.rtrim(F.col("text"), F.lit(WHITE))
    first = F.substring("role", 1, 1)
    role = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    rows = _in_order(turns).orderBy("conv_id", "turn", "role", "text").select(
        "conv_id", "role", F.sha2("text", 256).alias("said"), role.alias("of"), (F.length(spoken) == 0).alias("blank"),
        F.substring(spoken, -1, 1).isin(".", "!", "?").alias("ended"), F.monotonically_increasing_id().alias("at"))
    # Written, so that places stay as they are.
    rows = written(rows, "turns-in-order")
    firsts = rows.groupBy("conv_id", "role", "said").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    fault = F.when(F.col("blank"), 1).when(F.col("new").isNull(), 2).when(~F.col("ended"), 3).otherwise(0)
    coded = rows.join(firsts, "at", "left").select(
        "conv_id", "at", F.lower(F.hex((F.col("of") + 4 * fault).cast("long"))).alias("code"), F.shiftright("at", CHUNK).alias("chunk"))

    def together(df: DataFrame, keys: list[str], at: str, what: str) -> DataFrame:
        listed = F.sort_array(F.collect_list(F.struct(at, what)))
        return df.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda s: s[what]), "").alias(what))

    return together(together(coded, ["conv_id", "chunk"], "at", "code"), ["conv_id"], "chunk", "code")


class _Table:
    """Costs of aligning the rows from i on to the last r letters of the alternating string, within a band."""

    def __init__(self, role: np.ndarray, forced: np.ndarray, cut: np.ndarray, excess: int):
        self.role, self.forced, self.cut, self.n = role, forced, cut, len(role)
        stay = np.append(np.cumsum((~forced)[::-1])[::-1], 0)
        late = np.append(np.cumsum((cut & ~forced)[::-1])[::-1], 0)
        e = excess
        self.low = np.maximum(stay - late - e // DELETE, 0)
        # Each truncated row that stays costs CUT instead of DELETE.
        kept = e // (CUT - DELETE)
        high = np.where(kept <= late, stay - late + kept, stay + np.maximum(e - (CUT - DELETE) * late, 0) // INSERT)
        self.high = np.maximum(high, self.low)
        last = np.arange(self.low[-1], self.high[-1] + 1, dtype=np.int64) * INSERT
        self.kept = {self.n: last}
        self.block: dict[int, np.ndarray] = {}
        line = last
        for i in range(self.n - 1, -1, -1):
            line = self._above(i, line)
            if i % LINES == 0:
                self.kept[i] = line

    def _above(self, i: int, line: np.ndarray) -> np.ndarray:
        """Line i from line i + 1."""
        low, high, under = int(self.low[i]), int(self.high[i]), int(self.low[i + 1])
        # Line i + 1 at r = low - 1 .. high.
        wide = np.full(high - low + 2, INFINITE, np.int64)
        a, b = max(low - 1, under), min(high, under + len(line) - 1)
        if a <= b:
            wide[a - low + 1:b - low + 2] = line[a - under:b - under + 1]
        out = wide[1:] + DELETE
        if not self.forced[i]:
            # The letter with r to come is a where r is odd.
            odd = (np.arange(low, high + 1) & 1).astype(bool)
            wrong = odd != (self.role[i] == 2) if self.role[i] in (1, 2) else np.ones(len(odd), bool)
            matched = wide[:-1] + REROLE * wrong + CUT * int(self.cut[i])
            if low == 0:
                matched[0] = INFINITE
            out = np.minimum(out, matched)
        ramp = INSERT * np.arange(len(out))
        return np.minimum(np.minimum.accumulate(out - ramp) + ramp, INFINITE)

    def line(self, i: int) -> np.ndarray:
        if i in self.kept:
            return self.kept[i]
        if i not in self.block:
            top = min((i // LINES + 1) * LINES, self.n)
            self.block, line = {}, self.kept[top]
            for j in range(top - 1, i // LINES * LINES, -1):
                line = self.block[j] = self._above(j, line)
        return self.block[i]

    def at(self, i: int, r: int) -> int:
        k = r - int(self.low[i])
        line = self.line(i)
        return int(line[k]) if 0 <= k < len(line) else INFINITE

    def even(self, i: int, least: int) -> int:
        """The least cost of an even number of letters from `least` on."""
        low = max(int(self.low[i]), least)
        low += low & 1
        line = self.line(i)[low - int(self.low[i])::2]
        return int(line.min()) if len(line) else INFINITE

    def starts(self, i: int, least: int, cost: int) -> list[int]:
        low = max(int(self.low[i]), least)
        low += low & 1
        return [low + 2 * int(k) for k in np.flatnonzero(self.line(i)[low - int(self.low[i])::2] == cost)]


def align(codes: str) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of rows with these codes."""
    code = np.array([int(c, 16) for c in codes], np.int64)
    role, fault = code & 3, code >> 2
    forced, cut, n = (fault == 1) | (fault == 2), fault == 3, len(code)
    must = DELETE * int((forced | cut).sum())
    opens = (role == 0) & ~forced
    excess = FIRST_BAND
    while True:
        table = _Table(role, forced, cut, excess)
        # The cheapest repair of the rows from i on that starts with a kept s; all before it are deleted.
        lead = np.full(n + 1, INFINITE, np.int64)
        for i in range(n - 1, -1, -1):
            lead[i] = min(lead[i + 1] + DELETE, CUT * int(cut[i]) + table.even(i + 1, 2) if opens[i] else INFINITE)
        cost = min(table.even(0, 0), int(lead[0]))
        if cost - must <= excess:
            break
        excess = min(2 * excess, cost - must)
    # All alignments that start with the audit so far and cost least: letters to come, and whether an s is awaited.
    audit, i, left = [], 0, cost
    live, awaits = table.starts(0, 0, cost), int(lead[0]) == cost
    while not (i == n and left == 0 and 0 in live):
        if i < n:
            then = [r for r in live if table.at(i + 1, r) == left - DELETE]
            waits = awaits and int(lead[i + 1]) == left - DELETE
            if then or waits:
                audit.append("D")
                live, awaits, left, i = then, waits, left - DELETE, i + 1
                continue
        then = [r - 1 for r in live if r and table.at(i, r - 1) == left - INSERT]
        if then:
            audit.append("I")
            live, awaits, left = then, False, left - INSERT
            continue
        stays = CUT * int(cut[i])
        then = [r - 1 for r in live if r and role[i] == 1 + (r & 1) and table.at(i + 1, r - 1) == left - stays] if not forced[i] else []
        if awaits and opens[i]:
            then += [r for r in table.starts(i + 1, 2, left - stays) if r not in then]
        if then:
            audit.append("K")
            live, awaits, left, i = then, False, left - stays, i + 1
            continue
        audit.append("R")
        left -= REROLE + stays
        live = [r - 1 for r in live if r and role[i] != 1 + (r & 1) and table.at(i + 1, r - 1) == left]
        awaits, i = False, i + 1
    return cost, "".join(audit)


def _illegal(codes: str) -> int:
    roles = "".join("sua."[int(c, 16) & 3] for c in codes)
    return sum(roles[k:k + 2] not in ("su", "ua", "au") for k in range(len(roles) - 1))


def audits(turns: DataFrame) -> DataFrame:
    """conv_id, blank, duplicate, truncated, illegal, cost, audit of every conversation that has rows.

    illegal counts neighbouring rows whose role initials are not su, ua or au.
    """
    codes = _codes(turns)
    schema = AUDITS.format(codes.schema["conv_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Short conversations mostly have one of few codes.
        short = lru_cache(1 << 14)(align)
        for batch in batches:
            rows = [(c, *(short if len(c) <= 64 else align)(c)) for c in batch.column("code").to_pylist()]
            count = lambda digits: pa.array([sum(map(c.count, digits)) for c, *_ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), count("4567"), count("89ab"), count("cdef"), pa.array([_illegal(c) for c, *_ in rows], pa.int64()),
                 pa.array([x for _, x, _ in rows], pa.int64()), pa.array([a for *_, a in rows], pa.string())],
                ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])

    # By number, as AQE would put the short strings into one task, whatever their alignment costs.
    width = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(codes.repartition(width, "conv_id").mapInArrow(run, schema), "audits")


def gaps(turns: DataFrame) -> DataFrame:
    """conv_id, gaps: turn numbers that are missing between the least and the greatest of a conversation."""
    once = turns.select("conv_id", F.col("turn").cast("long").alias("turn")).distinct()
    wide = lambda c: c.cast("decimal(20,0)")
    n = wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count("turn")
    return once.groupBy("conv_id").agg(F.coalesce(n, F.lit(0)).try_cast("long").alias("gaps"))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, role, text) of the repaired rows, from each audit followed by its rows in order; (conv_id, None, None) ahead."""
    conv, edits, at, last = None, "", 0, None

    def inserted():
        nonlocal at, last
        while at < len(edits) and edits[at] == "I":
            at, last = at + 1, "u" if last != "u" else "a"
            yield conv, ROLES[last], ""

    for batch in batches:
        for c, kind, edit, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "kind", "audit", "role", "text")), strict=True):
            if kind == 0:
                yield from inserted()
                conv, edits, at, last = c, edit, 0, None
                yield conv, None, None
                continue
            yield from inserted()
            move, at = edits[at], at + 1
            if move != "D":
                last = role[:1] if move == "K" else "u" if last != "u" else "a"
                yield conv, role if move == "K" else ROLES[last], text
    yield from inserted()


def _beside(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Each audit and after it the rows of its conversation in order, a conversation in one task."""
    none = lambda kind: F.lit(None).cast(kind)
    lead = found.select("conv_id", F.lit(0).alias("kind"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), "audit")
    rows = _in_order(turns).select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", none("string").alias("audit"))
    return lead.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text")


def repaired(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place (from 0), role, text: the rows after the edits of the audits `found`."""
    rows = _beside(turns, found)
    kind = rows.schema["conv_id"].dataType
    to = pa.schema([("conv_id", to_arrow_type(kind)), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, place = [], 0, 0
        for conv, role, text in _edited(batches):
            if role is None:
                place = 0
                continue
            out.append({"conv_id": conv, "place": place, "role": role, "text": text})
            place, size = place + 1, size + 64 + len(text)
            if size >= BATCH:
                yield pa.RecordBatch.from_pylist(out, to)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, to)

    return rows.mapInArrow(run, f"conv_id {kind.simpleString()}, place long, role string, text string")


def digests(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256: hash of the repaired rows `role:text`, joined by line breaks, of each audited conversation."""
    rows = _beside(turns, found)
    kind = rows.schema["conv_id"].dataType
    to = pa.schema([("conv_id", to_arrow_type(kind)), ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, mark, open_, conv = [], b"", None, None
        for at, role, text in _edited(batches):
            if role is None:
                if open_ is not None:
                    out.append({"conv_id": conv, "repaired_sha256": open_.hexdigest()})
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_pylist(out, to)
                    out = []
                open_, conv, mark = sha256(), at, b""
                continue
            open_.update(mark + f"{role}:{text}".encode())
            mark = b"\n"
        if open_ is not None:
            out.append({"conv_id": conv, "repaired_sha256": open_.hexdigest()})
            yield pa.RecordBatch.from_pylist(out, to)

    return rows.mapInArrow(run, f"conv_id {kind.simpleString()}, repaired_sha256 string")


def repair(turns: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """Everything of `gaps`, `audits` and `digests` in a row of each conv_id of `originals` (the turns' own if None).

    A conversation without rows has zeros, an empty audit and the hash of nothing.
    """
    found = audits(turns)
    out = (turns if originals is None else originals).select("conv_id").distinct()
    for part in (gaps(turns), found, digests(turns, found)):
        part = part.withColumnRenamed("conv_id", "_of")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_of")), "left").drop("_of")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
