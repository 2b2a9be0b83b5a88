"""Does the region of an address belong to its country?

An address is free text such as ``Austin, Texas, USA`` or ``usa / texas``: its parts, split at
commas, slashes and semicolons, are looked up in a hierarchy table ``(country, subdivision)``,
in any order and case. A name may be a country and a subdivision at once, or a subdivision of
several countries; a part that can be a country counts as one.

Verdicts, the first that holds:

* ``missing``: no part at all (null, blank)
* ``mismatch``: a country is named, and a subdivision that belongs to none of the countries named
* ``unknown``: a part is neither a country nor a subdivision
* ``partial``: a country without a subdivision, or the other way round
* ``consistent``

Rows are reduced to distinct addresses before anything is looked up, so an address that a third
of all rows share is one row. Names meet the hierarchy in a join by name.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = "[,/;]"
VERDICTS = ("missing", "mismatch", "unknown", "partial", "consistent")


def parts_of(address: Column) -> Column:
    """The distinct names in an address, upper-cased, blank ones left out."""
    names = F.transform(F.split(F.coalesce(address, F.lit("")), SEPARATORS), lambda x: F.upper(F.trim(x)))
    return F.array_distinct(F.filter(names, lambda x: x != ""))


def known_names(hierarchy: DataFrame) -> DataFrame:
    """``(name, is_country, parents)``; ``parents`` are the countries that have a subdivision of that name."""
    country, subdivision = (F.upper(F.trim(c)) for c in ("country", "subdivision"))
    listed = hierarchy.select(country.alias("name"), F.lit(True).alias("is_country"), F.lit(None).cast("string").alias("parent"))
    below = hierarchy.select(subdivision.alias("name"), F.lit(False).alias("is_country"), country.alias("parent"))
    return (listed.unionByName(below).filter(F.col("name").isNotNull()).groupBy("name")
            .agg(F.max("is_country").alias("is_country"), F.collect_set("parent").alias("parents")))


def address_verdicts(df: DataFrame, address: str, hierarchy: DataFrame) -> DataFrame:
    """``(address, rows, verdict)`` for each distinct address of ``df``, a null one included."""
    distinct = df.groupBy(F.col(address).alias("address")).agg(F.count(F.lit(1)).alias("rows"))
    parts = distinct.select("address", F.explode(parts_of(F.col("address"))).alias("part"))
    found = parts.join(known_names(hierarchy), F.col("part") == F.col("name"), "left").groupBy("address").agg(
        F.collect_list(F.when(F.col("is_country"), F.col("part"))).alias("countries"),
        F.collect_list(F.when(~F.col("is_country"), F.col("parents"))).alias("regions"),
        F.count_if(F.col("name").isNull()).alias("strangers"))
    stray = F.exists("regions", lambda parents: ~F.arrays_overlap(parents, F.col("countries")))
    countries, regions = F.size("countries"), F.size("regions")
    verdict = (F.when(F.col("countries").isNull(), "missing")
               .when((countries > 0) & stray, "mismatch")
               .when(F.col("strangers") > 0, "unknown")
               .when((countries == 0) | (regions == 0), "partial")
               .otherwise("consistent"))
    return (distinct.join(found.withColumnRenamed("address", "_address"), F.col("address") == F.col("_address"), "left")
            .select("address", "rows", verdict.alias("verdict")))
