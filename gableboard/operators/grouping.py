"""Shared grouping shapes.

All of them tolerate one key holding a large share of the rows: rows are combined
before they are shuffled, and ranking inside a key keeps only the first few values per
task before the exchange.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from gableboard.session import settled


@dataclass(frozen=True)
class Facet:
    """The `k` most frequent values of a column per key, joined by `, `."""

    column: str
    k: int = 3


def facet_summary(
    rows: DataFrame,
    keys: Sequence[str],
    measures: dict[str, Column],
    facets: dict[str, Facet],
    distinct: dict[str, str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Totals, most frequent values and distinct counts per key in one scan.

    Every row is expanded into a total row and one row per facet, then combined by
    (key, facet, value) on the map side and once more after one exchange. Ties in a
    facet go to the smaller value. A null key is a key; a null facet value is none.
    Measures may not read a facet column. Where rows are already combined, `weight` is the
    column that says how many each stands for; a facet value without any counts as none.
    """
    keys, distinct = list(keys), distinct or {}
    counted = {f.column for f in facets.values()} - set(distinct.values())
    payload = [c for c in rows.columns if c not in keys and c not in counted]
    stands = F.lit(1) if weight is None else F.col(weight)
    total = F.struct(F.lit(0).alias("f"), F.lit(None).cast("string").alias("v"),
                     *[F.col(c) for c in payload], stands.alias("_w"))
    variants = [total]
    for i, facet in enumerate(facets.values(), 1):
        # Facet rows carry no payload: they are only counted.
        variants.append(F.struct(
            F.lit(i).alias("f"), F.col(facet.column).alias("v"),
            *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in payload], stands.alias("_w")))
    expanded = (
        rows.select(*keys, F.explode(F.array(*variants)).alias("x")).select(*keys, "x.*")
        .filter((F.col("f") == 0) | (F.col("v").isNotNull() & (F.col("_w") > 0)))
    )
    combined = expanded.groupBy(*keys, "f", "v").agg(
        F.sum("_w").alias("_n"),
        *[c.alias(name) for name, c in measures.items()],
        *[F.count_distinct(c).alias(name) for name, c in distinct.items()],
    )
    deepest = max(f.k for f in facets.values())
    order = W.partitionBy(*keys, "f").orderBy(F.desc("_n"), F.asc("v"))
    leading = combined.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= deepest)

    on_total = lambda name: F.max(F.when(F.col("f") == 0, F.col(name))).alias(name)
    out = [on_total(name) for name in [*measures, *distinct]]
    for i, (name, facet) in enumerate(facets.items(), 1):
        here = (F.col("f") == i) & (F.col("rn") <= facet.k)
        if facet.k == 1:
            out.append(F.max(F.when(here, F.col("v"))).alias(name))
        else:
            listed = F.sort_array(F.collect_list(F.when(here, F.struct("rn", "v"))))
            joined = F.array_join(F.transform(listed, lambda s: s["v"]), ", ")
            out.append(F.nullif(joined, F.lit("")).alias(name))
    return leading.groupBy(*keys).agg(*out)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                  rank: str = "rank") -> DataFrame:
    """First `n` rows of every group with their position."""
    window = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def top_overall(df: DataFrame, order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First `n` rows with their position; the window sees only those `n` rows."""
    head = df.orderBy(*order).limit(n)
    return head.withColumn(rank, F.row_number().over(W.orderBy(*order)))


def numbered(df: DataFrame, order: Sequence[Column], rank: str) -> DataFrame:
    """Unique positions 1..N over all rows without gathering them in one task.

    The rows are range-sorted and materialised, so that partition numbers and positions
    inside a partition stay fixed; the only single-task step adds up one count per
    partition. `order` must be total.
    """
    placed = settled(df.orderBy(*order)).withColumn("_at", F.monotonically_increasing_id())
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    # One row per partition of the sort: bounded by the shuffle width, not by the data.
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(rank, F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1)
        .drop("_at", "_part", "_start")
    )


def _in_partition(key: str, time: str, values: Sequence[str], skip_nulls: bool):
    """The step inside one sorted partition: each row beside the values before it, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs, at, held, before = TaskContext.get().partitionId(), 0, 0, None, None
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            if before is None:
                before = {c: pa.nulls(1, batch.column(c).type) for c in (key, time, *values)}
            column = {c: pa.concat_arrays([before[c], batch.column(c)]) for c in before}
            names, timeless = column[key], column[time].is_null().to_numpy(zero_copy_only=False)
            equal = pc.or_(pc.fill_null(pc.equal(names[1:], names[:-1]), False), pc.and_(names[1:].is_null(), names[:-1].is_null()))
            same = equal.to_numpy(zero_copy_only=False) & (timeless[1:] == timeless[:-1])
            same[0] &= at > 0
            place = np.arange(n)
            # Places count the row carried from the batch before as 0.
            start = np.maximum.accumulate(np.where(same, 0, place + 1))
            before, prev = {c: column[c].slice(n) for c in (key, time)}, []
            for v in values:
                there = place
                if skip_nulls:
                    known = column[v].is_valid().to_numpy(zero_copy_only=False)
                    latest = np.maximum.accumulate(np.where(known, np.arange(n + 1), -1))
                    there = latest[:-1]
                    last = latest[-1] if latest[-1] >= start[-1] else -1
                    before[v] = column[v].slice(last, 1) if last >= 0 else pa.nulls(1, column[v].type)
                else:
                    before[v] = column[v].slice(n)
                # Row i stands at place i + 1; its run starts at start[i], and at 0 if it goes on from the batch before.
                prev.append(column[v].take(pa.array(there, mask=there < np.where(same | skip_nulls, np.minimum(start, place + 1), n + 1))))
            head = np.cumsum(~same) + runs <= 1
            runs += int((~same).sum())
            out = [*batch.columns, *prev, pa.array(same), pa.array(head), pa.array(np.full(n, part, np.int32)), pa.array(place + at), pa.array(np.zeros(n, bool))]
            at += n
            if held is not None:
                yield held
            held = pa.RecordBatch.from_arrays(out, [*batch.schema.names, *[f"prev_{v}" for v in values], "has_prev", "_head", "_part", "_at", "_last"])
        if held is not None:
            last = np.zeros(len(held), bool)
            last[-1] = True
            yield held.set_column(held.schema.get_field_index("_last"), "_last", pa.array(last))
    return run


def with_previous(
    rows: DataFrame,
    key: str,
    values: Sequence[str],
    *,
    time: str = "observed_at",
    seq: str = "seq",
    skip_nulls: bool = False,
) -> DataFrame:
    """Add `prev_<value>` and `has_prev`: the values just before a row of the same key.

    With `skip_nulls` each value is the latest non-null one before the row. Rows are range
    partitioned by (key, time, seq) once, so a key, and a day of a key, with very many rows
    lies in many partitions. A step runs inside each partition in constant memory; across
    partitions only the last row of each is carried on. Rows without a time are a
    sequence of their own. The step's result is checkpointed: one scan of the source (besides
    the sample for the ranges), one exchange of the rows, one of a row or two a partition.
    """
    values = list(values)
    schema = StructType([
        *rows.schema, *[StructField(f"prev_{v}", rows.schema[v].dataType) for v in values],
        *[StructField(name, kind) for name, kind in (
            ("has_prev", BooleanType()), ("_head", BooleanType()), ("_part", IntegerType()), ("_at", LongType()), ("_last", BooleanType()))]])
    order = [F.col(key), F.col(time), F.col(seq)]
    stepped = settled(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _in_partition(key, time, values, skip_nulls), schema))
    carried = lambda v: F.coalesce(v, f"prev_{v}") if skip_nulls else F.col(v)
    same_run = [F.col(key).alias("_key"), F.col(time).isNull().alias("_timeless")]
    tails = stepped.filter("_last").select(*same_run, "_part", F.lit(1).alias("_kind"), F.struct(*[carried(v).alias(v) for v in values]).alias("_v"))
    heads = stepped.filter("_at = 0").select(*same_run, "_part", F.lit(0).alias("_kind"), F.lit(None).cast(tails.schema["_v"].dataType).alias("_v"))
    earlier = W.partitionBy("_key", "_timeless").orderBy("_part", "_kind").rowsBetween(W.unboundedPreceding, -1)
    last = lambda c: F.last(c, ignorenulls=True).over(earlier)
    before = [last(F.col("_v")[v]).alias(f"_c_{v}") if skip_nulls else last(F.col("_v"))[v].alias(f"_c_{v}") for v in values]
    # A row for each partition of the sort: bounded by the shuffle width, not by the data.
    carry = tails.unionByName(heads).select("_part", "_kind", last(F.col("_v")).isNotNull().alias("_more"), *before).filter("_kind = 0").drop("_kind")
    out = stepped.join(F.broadcast(carry), "_part", "left")
    here = F.col("_head") & F.col("_more")
    for v in values:
        across = F.when(here, F.col(f"_c_{v}"))
        out = out.withColumn(f"prev_{v}", F.coalesce(f"prev_{v}", across) if skip_nulls
                             else F.when(F.col("has_prev"), F.col(f"prev_{v}")).otherwise(across))
    return out.withColumn("has_prev", F.col("has_prev") | here).select(
        *rows.columns, *[f"prev_{v}" for v in values], "has_prev")


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of every key by `order`, as one combinable aggregate."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*").select(*df.columns)
