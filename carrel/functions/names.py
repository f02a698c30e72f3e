"""Column expressions that take names, titles and references apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from carrel.functions.text import col, filled, found, strip, stripped, tokens

#: Fixed values of Roman numerals after names.
ROMAN = {"I": 1, "II": 2, "III": 3, "IV": 4, "V": 5, "VI": 6, "VII": 7, "VIII": 8, "IX": 9, "X": 10, "XI": 11, "XII": 12}


def without_marks(name: Column | str) -> Column:
    """Struct of a name without its marks, and what they say.

    ``(syllabic`` anywhere and in any case gives syllabic, and is taken away only as a whole mark at
    the end, as ``(IV)`` is, which gives ordinal; ``, var. X`` gives variants, in order of their letters.
    """
    n = col(name)
    # behind each mark a variant stands up to the next comma or parenthesis; without one the mark is text
    pieces = F.split(n, r"\Q, var. \E")
    told = F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda x: F.struct(x.alias("all"), F.regexp_extract(x, "^[^,(]*", 0).alias("own")))
    variants = F.filter(F.transform(told, lambda t: t["own"]), lambda v: v != "")
    left = F.transform(told, lambda t: F.when(t["own"] == "", F.concat(F.lit(", var. "), t["all"])).otherwise(F.substr(t["all"], F.length(t["own"]) + 1)))
    table = F.create_map(*(F.lit(x) for pair in ROMAN.items() for x in pair))
    bare = F.concat(pieces[0], F.array_join(left, ""))
    bare = F.regexp_replace(bare, r"(?i)\s*\(syllabic\)\s*$", "")
    roman = found(bare, r"\(([IVX]+)\)\s*$")
    bare = F.regexp_replace(bare, r"\s*\([IVX]+\)\s*$", "")
    return F.struct(
        stripped(bare).alias("name"),
        F.lower(n).contains("(syllabic").alias("syllabic"),
        table[roman].alias("ordinal"),
        F.array_sort(F.array_distinct(F.transform(variants, strip))).alias("variants"),
    )


def parenthesis_variants(name: Column | str) -> Column:
    """Struct (name, variants): each group in parentheses holds variants between commas.

    A doubtful ``(?)`` at the end is dropped first; a name that is one group stays as it is.
    """
    n = strip(col(name))
    n = F.when(n.endswith("(?)"), strip(F.left(n, F.length(n) - 3))).otherwise(n)
    whole = n.rlike(r"^\s*\([^()]*\)\s*$")
    inner = F.regexp_extract_all(n, F.lit(r"\(([^()]*)\)"), 1)
    variants = F.filter(F.flatten(F.transform(inner, lambda g: F.transform(F.split(g, ","), strip))), lambda x: x != "")
    outside = strip(F.regexp_replace(F.regexp_replace(n, r"\([^()]*\)", " "), r"\s+", " "))
    empty = F.array().cast("array<string>")
    return F.struct(F.when(whole, strip(n)).otherwise(outside).alias("name"), F.when(whole, empty).otherwise(F.array_distinct(variants)).alias("variants"))


def paired_titles(value: Column | str, kind: Column | str) -> Column:
    """Array of (name, kind) from ``A/B, C/D`` and ``k/l``: names of one place share a kind.

    Groups stand between commas, alternatives between slashes. As many alternatives as kinds are
    needed in each group, else the query fails.
    """
    kinds = F.transform(F.split(col(kind), "/"), strip)
    groups = F.transform(F.split(col(value), ","), lambda g: F.transform(F.split(g, "/"), strip))
    bad = F.exists(groups, lambda g: F.size(g) != F.size(kinds))
    pairs = F.flatten(F.transform(groups, lambda g: F.zip_with(g, kinds, lambda a, k: F.struct(a.alias("name"), k.alias("kind")))))
    return F.when(bad, F.raise_error(F.concat(F.lit("titles and kinds differ in number: "), col(value))).cast("array<struct<name:string,kind:string>>")).otherwise(pairs)


def enumeration(c: Column | str) -> Column:
    """Array of (number, text) from ``1: one; 2: two``; any other text is the one entry 1."""
    item = r"(?:^|;\s*)(\d+):\s*(.*?)(?=;\s*\d+:|$)"
    numbers = F.transform(F.regexp_extract_all(col(c), F.lit(item), 1), lambda x: x.cast("int"))
    texts = F.transform(F.regexp_extract_all(col(c), F.lit(item), 2), strip)
    many = F.zip_with(numbers, texts, lambda n, t: F.struct(n.alias("number"), t.alias("text")))
    one = F.array(F.struct(F.lit(1).alias("number"), strip(c).alias("text")))
    return F.when(stripped(c).isNull(), F.array().cast("array<struct<number:int,text:string>>")).when(col(c).rlike(r"^\s*\d+:"), many).otherwise(one)


def references(c: Column | str, prefix: str = "PM") -> Column:
    """References between ``;`` or `` et `` before a digit, with an elided prefix restored."""
    parts = F.filter(F.transform(F.split(col(c), r"\s*;\s*|\s+et\s+(?=\d)"), strip), lambda x: x != "")
    return F.transform(parts, lambda x: F.when(x.rlike(r"^\d"), F.concat(F.lit(prefix + " "), x)).otherwise(x))


def last_locality(c: Column | str, pattern: str, default: Column | str) -> Column:
    """The last place found in a text, unless the default already says it."""
    all_found = F.regexp_extract_all(col(c), F.lit(pattern), 1)
    last = F.try_element_at(all_found, F.lit(-1))
    return F.when(last.isNull() | F.coalesce(F.contains(col(default), last), F.lit(False)), col(default)).otherwise(last)


def confidence_and_reference(name: Column | str, hedges: list[tuple[str, str]], prefix: str = "") -> Column:
    """Struct (confidence, reference): the first hedge found in any case, and ``[ 12 A ]``'s number.

    A reference is a number with a letter or none, in brackets; ``[60 A]`` gives ``60a`` behind the prefix.
    """
    confidence = F.lit(None).cast("string")
    for token, label in reversed(hedges):
        confidence = F.when(F.lower(col(name)).contains(token.lower()), F.lit(label)).otherwise(confidence)
    number = filled(F.lower(F.regexp_replace(found(name, r"\[\s*(\d+\s*[a-zA-Z]?)\s*\]"), r"\s", "")))
    return F.struct(confidence.alias("confidence"), F.concat(F.lit(prefix), number).alias("reference"))


def parallel_references(names: Column | str, prefix: str = "") -> Column:
    """The reference of each name of a list, null for one without, in the list's order; none for a null list."""
    empty = F.array().cast("array<string>")
    return F.transform(F.coalesce(col(names), empty), lambda n: confidence_and_reference(n, [], prefix)["reference"])


def compact(name: Column | str) -> Column:
    """A name of several words as one: no spaces and commas, a final ``ra`` as ``re``, one capital."""
    low = F.lower(F.translate(col(name), " ,", ""))
    low = F.regexp_replace(low, "ra$", "re")
    return F.when(col(name).contains(" "), F.concat(F.upper(F.substring(low, 1, 1)), F.substr(low, F.lit(2))))


def without_symbols(c: Column | str) -> Column:
    """Without gender and other signs, and without remarks that name a symbol."""
    out = strip(F.regexp_replace(col(c), r"\p{InMiscellaneousSymbols}", ""))
    return stripped(F.regexp_replace(out, r"\s*[(](?=[^)]*symbol)[^)]*[)]", ""))


def without_own_name(notes: Column | str, name: Column | str) -> Column:
    """Notes without the row's own name, taken literally, at their start."""
    pattern = F.concat(F.lit(r"(?i)^\s*\Q"), F.replace(col(name), F.lit("\\E"), F.lit("")), F.lit(r"\E\s*[,:;.]?\s*"))
    return F.when(stripped(name).isNull(), col(notes)).otherwise(stripped(F.regexp_replace(col(notes), pattern, F.lit(""))))


def ordinal_word(label: Column | str) -> Column:
    """The number of a heading: digits with st, nd, rd or th, else the longest ordinal word in it."""
    digits = found(label, r"(?<!\S)(\d+)(?:st|nd|rd|th)(?=\s)").cast("int")
    ones = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth"]
    teens = ["tenth", "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth", "eighteenth", "nineteenth"]
    table = {w: i for i, w in enumerate(ones + teens, 1)} | {"twentieth": 20, "thirtieth": 30} | {f"{t}-{w}": n + i for t, n in (("twenty", 20), ("thirty", 30)) for i, w in enumerate(ones, 1)}
    hits = F.filter(F.array(*(F.struct(F.lit(-len(w)).alias("rank"), F.lit(w).alias("word"), F.lit(n).alias("number")) for w, n in table.items())), lambda x: F.contains(F.lower(col(label)), x["word"]))
    return F.coalesce(digits, F.get(F.array_sort(hits), F.lit(0))["number"])


def is_dynasty_marker(line: Column | str) -> Column:
    """Whether a row is a heading such as ``18. Dynastie`` or ``9./10. Dynastie`` and no ruler."""
    numbers, word = F.regexp_extract(col(line), r"\A(\S+)\s+(\S+)\z", 1), F.regexp_extract(col(line), r"\A(\S+)\s+(\S+)\z", 2)
    each = F.split(numbers, "/")
    return (word == "Dynastie") & (F.size(each) <= 2) & F.forall(each, lambda n: n.rlike(r"\A\d+[.]\z"))


def is_anti_king(notes: Column | str, word: str = "gegenkönig") -> Column:
    """Whether notes hold the word by itself; its plural speaks of others."""
    return F.coalesce(F.array_contains(tokens(notes), word), F.lit(False))


def existence_uncertain(name: Column | str) -> Column:
    """Whether a name is marked as of an uncertain person.

    Marks: all of it in parentheses, ``(?)`` at its end, a question mark and a space before it, German quotation marks in it.
    """
    n = F.coalesce(col(name), F.lit(""))
    wrapped = n.startswith("(") & n.endswith(")") & (F.length(n) > 2)
    opened = F.locate("„", n)
    quoted = (opened > 0) & (F.instr(F.substr(n, opened + 2), "“") > 0)  # something stands between them
    return wrapped | strip(n).endswith("(?)") | F.substr(n, F.lit(1), F.lit(2)).rlike(r"\A[?]\s") | quoted


def existence_doubtful(name: Column | str, notes: Column | str) -> Column:
    """Whether a name ends in a question mark, also in a parenthesis, is all in single quotes, or notes call its existence doubtful."""
    n = strip(F.coalesce(col(name), F.lit("")))
    inside = F.when(n.endswith(")"), strip(F.left(n, F.length(n) - 1))).otherwise(n)
    # Fixed value: the phrase of the notes.
    said = F.coalesce(col(notes).rlike(r"(?i)\bexistence,?\s+doubtful\b"), F.lit(False))
    return inside.endswith("?") | (n.startswith("'") & n.endswith("'")) | said
