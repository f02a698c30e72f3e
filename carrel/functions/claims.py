"""Roles of places and certainties of claims, each in a family of its own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carrel.functions.text import col, looked_up

#: What a museum's label of a place says: the kind of place, and how certain it is.
PLACE_ROLES = {
    "Made in": ("production", None),
    "From": ("findspot", "confirmed"),
    "Probably from": ("findspot", "probable"),
    "Possibly from": ("findspot", "uncertain"),
    "Said to be from": ("findspot", "uncertain"),
    "Place made": ("production", None),
    "Place modified": ("production", None),
    "Place excavated": ("findspot", "confirmed"),
    "Place found": ("findspot", "confirmed"),
    "Place collected": ("findspot", "confirmed"),
    "Reportedly from": ("findspot", "uncertain"),
    "Creation Place": ("production", None),
}
#: Fixed value: how labels begin that say a place is only possible.
POSSIBLE = "Possible place"


def place_role(label: Column | str) -> Column:
    """Struct (kind, certainty) of a place's label: production or findspot; null for an unknown label."""
    possible = col(label).startswith(POSSIBLE)
    kind = F.when(possible, "findspot").otherwise(looked_up(label, {k: v[0] for k, v in PLACE_ROLES.items()}))
    certainty = F.when(possible, "uncertain").otherwise(looked_up(label, {k: v[1] for k, v in PLACE_ROLES.items() if v[1]}))
    return F.struct(kind.alias("kind"), certainty.alias("certainty"))


def _said(flag: Column | str | None) -> Column:
    return F.lit(False) if flag is None else F.coalesce(col(flag), F.lit(False))


def existence(uncertain: Column | str | None = None, doubtful: Column | str | None = None) -> Column:
    """attested or doubtful: whether the source doubts that the person was."""
    return F.when(_said(uncertain) | _said(doubtful), "doubtful").otherwise("attested")


def attribution(stated: Column | str | None = None, uncertain: Column | str | None = None, name_uncertain: Column | str | None = None) -> Column:
    """attested, probable or uncertain: to whom something belongs, and which name a place in a list holds.

    A certainty that the source states itself counts first. An uncertain name is no doubt of existence.
    """
    own = F.lit(None).cast("string") if stated is None else F.when(col(stated).isin("attested", "probable", "uncertain"), col(stated))
    return F.coalesce(own, F.when(_said(uncertain) | _said(name_uncertain), "uncertain").otherwise("attested"))


def reigns_named(dating: Column | str, pattern: str = r"(?i)reigns? of ([\p{Lu}][\p{L}\-]*(?: [IVX]+\b)?)") -> Column:
    """The rulers that the text of a date names, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(col(dating), F.lit(pattern), 1))
