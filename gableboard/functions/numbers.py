"""Numbers in and out of text, and derived metrics, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from gableboard.functions.names import blank_to_null, col


def to_double(c: Column | str) -> Column:
    """Number from text such as `1,234.5`; null if it is none."""
    return blank_to_null(F.trim(F.replace(col(c).cast("string"), F.lit(","), F.lit("")))).try_cast("double")


def to_long(c: Column | str) -> Column:
    """Integer from text such as `$1,234.9` (cut, not rounded); null if it is none."""
    bare = F.replace(F.replace(col(c).cast("string"), F.lit("$"), F.lit("")), F.lit(","), F.lit(""))
    cleaned = F.trim(bare)
    number = blank_to_null(cleaned).try_cast("double")
    return number.try_cast("long")


def digits(c: Column | str) -> Column:
    """All digits of the text as one integer (`$585,000` -> 585000)."""
    return blank_to_null(F.regexp_replace(col(c).cast("string"), r"[^\d]", "")).try_cast("long")


def _half_even(x: Column, decimals: int) -> Column:
    """Fixed decimals, half to even, no grouping (the pattern form of `format_number`)."""
    pattern = "0." + "0" * decimals if decimals else "0"
    return F.call_function("format_number", x, F.lit(pattern))


def _money(c: Column | str, zero: str, billions: bool) -> Column:
    amount = col(c).cast("long")
    scaled = lambda unit, places, mark: F.concat(
        F.lit("$"), _half_even(amount / F.lit(float(unit)), places), F.lit(mark))
    out = F.when(F.coalesce(amount, F.lit(0)) == 0, F.lit(zero))
    if billions:
        out = out.when(amount >= 10**9, scaled(10**9, 1, "B"))
    return (
        out.when(amount >= 10**6, scaled(10**6, 1, "M"))
        .when(amount >= 10**3, scaled(10**3, 0, "K"))
        .otherwise(F.concat(F.lit("$"), F.format_number(amount, 0)))
    )


def money(c: Column | str) -> Column:
    """`$1.3M`, `$807K`, `$450`; `$0` for nothing."""
    return _money(c, "$0", False)


def money_or_na(c: Column | str) -> Column:
    """As `money` with billions, and `N/A` for nothing."""
    return _money(c, "N/A", True)


def money_full(c: Column | str) -> Column:
    """`$1,234,567`; `$0` for nothing."""
    return F.concat(F.lit("$"), F.format_number(F.coalesce(col(c).cast("long"), F.lit(0)), 0))


def money_value(c: Column | str) -> Column:
    """Number behind a formatted cell; null for `N/A`, a dash or text, which sort lowest."""
    text = F.replace(F.trim(col(c)), F.lit(","), F.lit(""))
    amount = F.regexp_extract(text, r"^\$?(-?\d+(?:\.\d+)?)", 1)
    unit = (
        F.when(F.contains(text, F.lit("M")), F.lit(1e6))
        .when(F.contains(text, F.lit("K")), F.lit(1e3))
        .otherwise(F.lit(1.0))
    )
    number = blank_to_null(amount).try_cast("double")
    money_cell = F.startswith(text, F.lit("$"))
    return F.when(money_cell, F.coalesce(number, F.lit(0.0)) * unit).otherwise(number)


def ratio_or_zero(top: Column | str, bottom: Column | str) -> Column:
    return F.coalesce(F.try_divide(col(top), col(bottom)), F.lit(0.0))


def percent_change(current: Column | str, prior: Column | str) -> Column:
    """Whole percent, cut towards zero; null without a prior value."""
    now, before = col(current), col(prior)
    return F.when(before > 0, ((now - before) / before * 100).cast("long"))


def estimated_volume(total: Column | str, average: Column | str) -> Column:
    return F.when(F.coalesce(col(average), F.lit(0)) != 0, col(total) * col(average))


def sales_not_shown(career: Column | str, shown: Column | str) -> Column:
    return F.when(col(career) > col(shown), col(career) - col(shown)).otherwise(F.lit(0))


def side_split(listing: Column | str, buyer: Column | str) -> Column:
    as_text = lambda c: F.coalesce(col(c), F.lit(0)).cast("string")
    return F.concat(as_text(listing), F.lit(" : "), as_text(buyer))


def delta_label(delta: Column | str, is_new: Column | str) -> Column:
    d = col(delta)
    return (
        F.when(col(is_new), F.lit("NEW"))
        .when(d > 0, F.concat(F.lit("▲"), d.cast("string")))
        .when(d < 0, F.concat(F.lit("▼"), F.abs(d).cast("string")))
        .otherwise(F.lit("—"))
    )


def trend_label(change: Column | str, is_new: Column | str, volume: Column | str) -> Column:
    tail = F.concat(F.lit(" ("), money(volume), F.lit(")"))
    return F.when(col(is_new), F.lit("NEW")).otherwise(
        F.concat(delta_label(change, F.lit(False)), tail))
