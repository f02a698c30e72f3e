"""Gazetteer places: kept by type, with coordinates, parents and references taken apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.functions.names import compact, without_symbols
from carrel.functions.text import found, labels

PLACE = "gazId string, prefName struct<title:string>, names array<struct<title:string>>, types array<string>, prefLocation string, parent string, identifiers array<struct<context:string,value:string>>"
#: Contexts of references that name one field, and whether its first or last one counts.
ONE_OF = {"geonames": (["geonames"], "last"), "pleiades": (["pleiades"], "last"), "gnd": (["gnd", "gnd-id"], "last"), "dai-arachne": (["dai-arachne", "arachne-entity", "arachne-place"], "first")}


def coordinates(location: Column | str) -> Column:
    """[lon, lat] of JSON ``[lon, lat]`` or ``{"coordinates": [lon, lat]}``; [0, 0] counts as none."""
    v = F.try_parse_json(location)
    pair = F.coalesce(F.try_variant_get(v, "$", "array<double>"), F.try_variant_get(v, "$.coordinates", "array<double>"))
    good = (F.size(pair) == 2) & F.get(pair, F.lit(0)).isNotNull() & F.get(pair, F.lit(1)).isNotNull() & ~((F.get(pair, F.lit(0)) == 0) & (F.get(pair, F.lit(1)) == 0))
    return F.when(good, pair)


def _of(ids: Column, contexts: list[str]) -> Column:
    return F.filter(ids, lambda x: F.lower(x["context"]).isin(contexts))


def references(identifiers: Column | str) -> Column:
    """Struct of one value for each known family of contexts, and all others as a list."""
    ids = F.coalesce(F.col(identifiers) if isinstance(identifiers, str) else identifiers, F.array())
    fields, known = [], []
    for name, (contexts, which) in ONE_OF.items():
        own = _of(ids, contexts)
        if which == "first":
            own = F.filter(own, lambda x: x["value"].isNotNull())
        fields.append(F.try_element_at(own, F.lit(1 if which == "first" else -1))["value"].alias(name))
        known += contexts
    return F.struct(*fields, F.filter(ids, lambda x: ~F.coalesce(F.lower(x["context"]).isin(known), F.lit(False))).alias("other"))


def reconcile(places: DataFrame, site_types: list[str], curated: list[str]) -> DataFrame:
    """Places of a wanted type, and curated ones of any type, shaped for lookup.

    parent_in_file: null without a parent, else whether the parent is kept too.
    """
    chosen = F.col("gazId").isin(curated)
    kept = places.filter(chosen | F.coalesce(F.arrays_overlap(F.coalesce("types", F.array()), F.array(*map(F.lit, site_types))), F.lit(False)))
    ids = kept.select(F.col("gazId").alias("_kept")).distinct()
    parent = found("parent", r"/place/(\d+)$")
    shaped = kept.withColumn("_parent", parent).join(ids, F.col("_parent") == F.col("_kept"), "left")
    return shaped.select(
        F.concat(F.lit("idai:"), "gazId").alias("id"),
        F.col("prefName.title").alias("display"),
        F.array_except(F.filter(F.array_distinct(F.coalesce(F.transform("names", lambda n: n["title"]), F.array().cast("array<string>"))), lambda x: x != ""), F.array("prefName.title")).alias("alt_labels"),
        coordinates("prefLocation").alias("coordinates"),
        F.coalesce("types", F.array().cast("array<string>")).alias("types"),
        F.concat(F.lit("idai:"), "_parent").alias("parent_id"),
        F.when(F.col("_parent").isNotNull(), F.col("_kept").isNotNull()).alias("parent_in_file"),
        chosen.alias("is_supplementary"),
        references("identifiers").alias("cross_refs"),
    )


def aliases(display: Column, index: Column, page: Column, prenomen: Column, transcriptions: Column) -> Column:
    """Other names of a ruler: index, page, compact prenomen, transcriptions without symbols."""
    short = compact(prenomen)
    short = F.when(F.lower(short) != F.lower(display), F.array(short))
    return labels(display, index, page, short, F.transform(transcriptions, without_symbols))
