"""Signed years: the years before the common era are negative integers, as no date type holds them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carrel.functions.text import col, found, strip, stripped

_DATE = r"(?i)^\s*(?:\?|\d{2,})\s*(?:BC|BCE|CE|AD)?\s*(?:[–-]\s*(?:\?|\d*)\s*(?:BC|BCE|CE|AD)?)?\s*$"


def is_date(c: Column | str) -> Column:
    """Whether a text is a year, of two digits or more, or a range of them, and not prose."""
    return F.coalesce(col(c).rlike(_DATE), F.lit(False))


def reign(c: Column | str, ascending: Column | bool = False) -> Column:
    """Struct (start, end) of a text such as ``1479-1425``, ``27 BC-14 CE`` or ``69``.

    An era mark settles its year and the other one's sign. Without marks, a falling range is before
    the common era and a rising one in it; for a single year or equal ones ``ascending`` decides.
    """
    parts = F.split(strip(c), "[–-]", 2)

    def part(i: int) -> tuple[Column, Column]:
        text = F.get(parts, F.lit(i))
        value = found(text, r"(\d+)").cast("int")
        era = F.when(text.rlike(r"(?i)\b(?:CE|AD)\b"), 1).when(text.rlike(r"(?i)\b(?:BC|BCE)\b"), -1)
        return value, F.when(value.isNotNull(), era)

    (a, era_a), (b, era_b) = part(0), part(1)
    own = F.when(F.lit(ascending) if isinstance(ascending, bool) else ascending, 1).otherwise(-1)
    guess = F.when(a > b, -1).when(a < b, 1).otherwise(own)
    sign = lambda x, other: F.coalesce(x, other, guess)
    return F.struct((a * sign(era_a, era_b)).alias("start"), (b * sign(era_b, era_a)).alias("end"))


def crosses_era(start: Column | str, end: Column | str) -> Column:
    """Whether a range spans both eras; a missing end fails the query."""
    fail = F.raise_error(F.lit("a range without both years")).cast("boolean")
    return F.when(col(start).isNull() | col(end).isNull(), fail).otherwise((col(start) < 0) & (col(end) > 0))


def precision(qualifier: Column | str, geological: Column) -> Column:
    """How exact a dating is: geological where it is said so, regnal_precise without a qualifier such as ``c.``, else regnal_approximate."""
    return F.when(F.coalesce(geological, F.lit(False)), "geological").when(col(qualifier).isNull(), "regnal_precise").otherwise("regnal_approximate")


def attested(start: Column | str, end: Column | str) -> Column:
    """Which years of a range are known: both, start_only, end_only or none."""
    return F.when(col(start).isNotNull() & col(end).isNotNull(), "both").when(col(start).isNotNull(), "start_only").when(col(end).isNotNull(), "end_only").otherwise("none")


def astronomical(year: Column | str) -> Column:
    """The year before 1 is 0: historical -N becomes -(N - 1)."""
    return F.when(col(year) < 0, col(year) + 1).otherwise(col(year))


def envelope(older: Column | str, younger: Column | str, approximate: Column | str | None = None) -> Column:
    """Bounds of a dating in astronomical years, with era, precision and why bounds are missing."""
    lo, hi = astronomical(F.least(col(older), col(younger))), astronomical(F.greatest(col(older), col(younger)))
    fuzzy = F.lit(False) if approximate is None else F.coalesce(col(approximate), F.lit(False))
    known = col(older).isNotNull() & col(younger).isNotNull()
    return F.struct(
        lo.alias("older"),
        hi.alias("younger"),
        F.when(hi <= 0, "bce").when(lo > 0, "ce").when(lo.isNotNull() & hi.isNotNull(), "both").alias("era"),
        F.when(~known, "unknown").when(fuzzy, "approximate").when(lo == hi, "exact").otherwise("range").alias("precision"),
        F.when(col(older).isNull() & col(younger).isNull(), "no_date").when(~known, "open_range").alias("null_reason"),
        F.when(known, hi - lo).alias("least_years"),
    )


def dating(c: Column | str, unit: str = "Dynasty") -> Column:
    """Struct (ids, qualifier, certainty, relation) of texts such as ``late Dynasty 18``.

    ``Dynasty 19-20`` gives both numbers and relation ``to``; ``, or later`` and ``, or earlier``
    give their relation; ``(probably)`` and ``(possibly)`` their certainty.
    """
    low = found(c, rf"(?i){unit}\s+(\d+)").cast("int")
    high = found(c, rf"(?i){unit}\s+\d+\s*[–-]\s*(?:{unit}\s+)?(\d+)").cast("int")
    ids = F.when(low.isNull(), F.array().cast("array<int>")).otherwise(F.sequence(F.least(low, F.coalesce(high, low)), F.greatest(low, F.coalesce(high, low))))
    qualifier = F.lower(found(c, r"(?i)\b(early|mid|middle|late)\b"))
    certainty = F.when(col(c).rlike(r"(?i)\bprobably\b"), "probable").when(col(c).rlike(r"(?i)\bpossibly\b|\?"), "possible").when(stripped(c).isNotNull(), "certain")
    relation = F.when(col(c).rlike(r"(?i),?\s*or later"), "or_later").when(col(c).rlike(r"(?i),?\s*or earlier"), "or_earlier").when(high.isNotNull(), "to")
    return F.struct(ids.alias("ids"), qualifier.alias("qualifier"), certainty.alias("certainty"), relation.alias("relation"))
