"""Name, office and place normalisation as column expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from gableboard.constants import DESIGNATIONS, OFFICE_SPELLINGS, PLACE_TO_TOWN, TOWNS

_REST = 2**31 - 1
_DESIGNATION = r"(?i),?\s*\b(" + "|".join(DESIGNATIONS) + r")\b\.?"


#: White space of any kind.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often `use` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def strip(c: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.btrim(c, F.lit(WHITE))


def squeeze(c: Column) -> Column:
    """Collapse runs of white space of any kind and trim."""
    return F.trim(F.regexp_replace(F.translate(c, WHITE, " " * len(WHITE)), " ++", " "))


def present(c: Column | str) -> Column:
    """True where the value is neither null nor only spaces (never null itself)."""
    return F.coalesce(strip(col(c)) != "", F.lit(False))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def title_case(c: Column) -> Column:
    """First letter of every letter run upper, the rest lower (`O'Brien Moody-Maxon`)."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(
        F.transform(
            runs,
            lambda r: F.concat(
                F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, _REST)),
            ),
        ),
        "",
    )


def agent_name(c: Column | str) -> Column:
    name = strip(col(c))
    name = F.regexp_replace(name, _DESIGNATION, "")
    name = F.regexp_replace(name, r"[,.\s]+$", "")
    name = F.regexp_replace(name, r"\s*\(.*?\)\s*", " ")
    return let(title_case(squeeze(name)), lambda n: F.when(n != "", n))


def groups(c: Column, pattern: str, n: int) -> Column:
    """The `n` groups of a pattern that spans the whole text, as an array; null if it does not.

    One replacement reads all groups, where an extraction per group would match `n` times.
    """
    mark = "\u0001"
    marked = F.regexp_replace(c, pattern, "".join(f"{mark}${i}" for i in range(1, n + 1)))
    return let(marked, lambda m: F.when(
        F.startswith(m, F.lit(mark)), F.slice(F.split(m, mark), 2, n)))


def _lookup(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])


def canonical(c: Column | str, table: dict[str, str]) -> Column:
    """Value of `table` under the lower-cased trimmed key, else the trimmed input."""
    trimmed = strip(col(c))
    return F.coalesce(F.try_element_at(_lookup(table), F.lower(trimmed)), trimmed)


def office_name(c: Column | str) -> Column:
    return F.when(present(c), canonical(c, OFFICE_SPELLINGS))


def place_name(c: Column | str) -> Column:
    return F.when(F.length(col(c)) > 0, canonical(c, PLACE_TO_TOWN))


def in_towns(c: Column | str, towns: tuple[str, ...] = TOWNS) -> Column:
    return F.coalesce(F.lower(col(c)).isin([t.lower() for t in towns]), F.lit(False))


def town_spelling(c: Column | str, towns: tuple[str, ...] = TOWNS) -> Column:
    """Town in its listed spelling whatever the case or separator; unknown text as is."""
    slugs = {t.lower().replace(" ", "_"): t for t in towns}
    key = F.regexp_replace(F.lower(strip(col(c))), "[-_ ]", "_")
    return F.coalesce(F.try_element_at(_lookup(slugs), key), col(c))
