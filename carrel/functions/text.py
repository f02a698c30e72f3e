"""Column expressions over strings and arrays of strings; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without leading and trailing white space of any kind, line ends included."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def filled(c: Column | str) -> Column:
    """Null for an empty string."""
    return F.nullif(col(c), F.lit(""))


def stripped(c: Column | str) -> Column:
    return filled(strip(c))


def split_clean(c: Column | str, pattern: str) -> Column:
    """Trimmed, non-empty parts between matches of a pattern; null where none is left."""
    parts = F.filter(F.transform(F.split(col(c), pattern), strip), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts)


def joined(separator: str, *parts: Column | str) -> Column:
    """Non-empty parts in order; null where none is left."""
    return filled(F.concat_ws(separator, *(filled(p) for p in parts)))


def found(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A group of the first match; null without a match, or for an empty one."""
    return filled(F.regexp_extract(col(c), pattern, group))


def looked_up(c: Column | str, table: dict) -> Column:
    """The table's value, null for other keys."""
    if not table:
        return F.lit(None).cast("string")
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[col(c)]


def open_code(c: Column | str, table: dict[str, str]) -> Column:
    """The table's value; any other text in lower case; null for null and empty."""
    return F.coalesce(looked_up(filled(c), table), F.lower(filled(c)))


def closed_code(c: Column | str, table: dict[str, str], what: str) -> Column:
    """The table's value; null for null and empty; any other text fails the query."""
    value = filled(c)
    return F.when(value.isNotNull(), F.coalesce(looked_up(value, table), F.raise_error(F.concat(F.lit(f"unknown {what}: "), value)).cast("string")))


def required(c: Column | str, what: str, record: Column | str) -> Column:
    """The text itself; a null or empty one fails the query and names the record."""
    return F.coalesce(filled(c), F.raise_error(F.concat(F.lit(f"missing {what} in record "), F.coalesce(col(record).cast("string"), F.lit("?")))).cast("string"))


def replaced(c: Column | str, pairs: list[tuple[str, str]]) -> Column:
    """Substrings replaced one pair after the other; order matters."""
    return reduce(lambda out, p: F.replace(out, F.lit(p[0]), F.lit(p[1])), pairs, col(c))


def words_replaced(c: Column | str, table: dict[str, str]) -> Column:
    """Whole words replaced, in lower case and with a capital first letter."""
    out = col(c)
    for old, new in table.items():
        for a, b in ((old, new), (old.capitalize(), new.capitalize())):
            out = F.regexp_replace(out, rf"(?<![\p{{L}}\p{{N}}_])\Q{a}\E(?![\p{{L}}\p{{N}}_])", b.replace("\\", "\\\\").replace("$", "\\$"))
    return out


def numerals_after(c: Column | str, names: list[str], misread: dict[str, str]) -> Column:
    """Misread numerals that follow one of the names, put right whatever their case; white space in one counts as any.

    misread: numeral as it is read -> as it should be; a longer one is tried before a shorter one.
    """
    said = "|".join(rf"\Q{n}\E" for n in names)
    out = col(c)
    for old, new in sorted(misread.items(), key=lambda x: (-len(x[0]), x[0])):
        numeral = r"\s+".join(rf"\Q{part}\E" for part in old.split())
        out = F.regexp_replace(out, rf"(?iu)(?<![\p{{L}}\p{{N}}_])({said})(\s+){numeral}(?![\p{{L}}\p{{N}}_])", f"$1$2{new}")
    return out


def without_tail(c: Column | str, start: str) -> Column:
    """Without everything from a match of ``start`` on, over line ends; null where nothing is left."""
    return stripped(F.regexp_replace(col(c), rf"(?s){start}.*$", ""))


def deeply(c: Column, kind: T.DataType, change: Callable[[Column], Column]) -> Column:
    """A change of texts made to every text at any depth of lists and structs."""
    if isinstance(kind, T.StringType):
        return change(c)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: deeply(x, kind.elementType, change))
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*(deeply(c[f.name], f.dataType, change).alias(f.name) for f in kind)))
    return c


def plain_names(c: Column | str, field: str = "name") -> Column:
    """Names from a JSON list of texts, or of objects that hold one under ``field``, or of both."""
    entries = F.from_json(col(c), "array<string>")
    return F.transform(entries, lambda x: F.when(x.rlike(r"^\s*\{"), F.coalesce(F.get_json_object(x, f"$.{field}"), x)).otherwise(x))


def first_label(c: Column | str, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """The label of the first pattern that matches; rules are (label, pattern), strongest first."""
    out = F.lit(otherwise)
    for label, pattern in reversed(rules):
        out = F.when(col(c).rlike(pattern), F.lit(label)).otherwise(out)
    return out


def prefix_label(c: Column | str, table: dict[str, str]) -> Column:
    """The label of the longest prefix of the table that a text begins with; null for others."""
    out = F.lit(None).cast("string")
    for prefix in sorted(table, key=len):
        out = F.when(col(c).startswith(prefix), F.lit(table[prefix])).otherwise(out)
    return out


def key(c: Column | str) -> Column:
    """Lower case, with white space collapsed: what aliases are matched on."""
    return filled(F.lower(F.regexp_replace(strip(c), r"(?U)\s+", " ")))


def tokens(c: Column | str) -> Column:
    """Lower-case runs of letters and digits of any script, in order."""
    return F.filter(F.split(F.lower(col(c)), r"[^\p{L}\p{M}\p{N}]+"), lambda x: x != "")


def token_sort(c: Column | str) -> Column:
    """Tokens in alphabetical order, joined by a space."""
    return F.array_join(F.array_sort(tokens(c)), " ")


def union_in_order(*arrays: Column) -> Column:
    """Elements of all arrays, each once, where it first stands; null arrays add none."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*(F.coalesce(a, empty) for a in arrays)))


def labels(display: Column | str, *arrays: Column) -> Column:
    """Other labels than the displayed one: in order, each once, without dashes and blanks."""
    kept = F.filter(union_in_order(*arrays), lambda x: x.isNotNull() & ~strip(x).isin("", "-", "–", "—"))
    return F.array_except(kept, F.array(col(display)))


def normal_for_diff(c: Column | str) -> Column:
    """For comparison: without asterisks, note marks as digits, white space collapsed."""
    out = F.translate(col(c), "⁰¹²³⁴⁵⁶⁷⁸⁹*", "0123456789")
    out = F.regexp_replace(out, r"\[\^(\d+)\]", "$1")
    out = F.regexp_replace(out, r"(?U)-\s+", "-")
    return strip(F.regexp_replace(out, r"(?U)\s+", " "))


def first_difference(a: Column | str, b: Column | str, context: int = 8) -> Column:
    """Struct (at, left, right) of the first differing character, from 1; null where equal."""
    a, b = F.coalesce(col(a), F.lit("")), F.coalesce(col(b), F.lit(""))
    longest = F.greatest(F.length(a), F.length(b))
    at = F.get(F.filter(F.sequence(F.lit(1), longest), lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1))), F.lit(0))
    cut = lambda x: F.substr(x, F.greatest(F.lit(1), at - context), F.lit(2 * context + 1))
    return F.when(a != b, F.struct(at.alias("at"), cut(a).alias("left"), cut(b).alias("right")))
