"""Similarity of two names: twice the longest common subsequence over both lengths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gableboard.functions.names import col


def _lcs_length(a: Column, b: Column) -> Column:
    left, right = F.split(a, ""), F.split(b, "")
    start = F.transform(F.concat(F.array(F.lit("")), right), lambda _: F.lit(0))

    def next_row(row: Column, ch: Column) -> Column:
        def cell(acc: Column, j: Column) -> Column:
            up, diagonal = F.element_at(row, j + 1), F.element_at(row, j)
            best = F.when(ch == F.element_at(right, j), diagonal + 1).otherwise(
                F.greatest(up, F.element_at(acc, -1)))
            return F.concat(acc, F.array(best))

        return F.aggregate(F.sequence(F.lit(1), F.size(right)), F.array(F.lit(0)), cell)

    return F.element_at(F.aggregate(left, start, next_row), -1)


def name_ratio(a, b) -> Column:
    """0 to 100; 100 for two empty names."""
    x, y = col(a), col(b)
    total = F.length(x) + F.length(y)
    lcs = F.when((F.length(x) == 0) | (F.length(y) == 0), F.lit(0)).otherwise(_lcs_length(x, y))
    return F.when(total == 0, F.lit(100.0)).otherwise(200.0 * lcs / total)
