"""Data-catalogue payloads, resource choice, listings and count APIs, all from landed text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PAYLOAD = "success boolean, error struct<message: string>, result struct<id: string, title: string, resources: array<struct<name: string, format: string, url: string>>>"
#: Formats and words that mark boundary files.
FORMATS = ["zipped shapefiles", "shapefile", "zip", "geojson", "json", "gpkg", "gokg"]
SUFFIXES = (".zip", ".geojson", ".json", ".gpkg", ".gokg")
WORDS_IN_NAME = ["shp", "shapefile"]
WORDS = ["adm", "admin", "administrative", "geojson", "json", "gpkg", "gokg", "geopackage"]


def resources(payloads: DataFrame, body: str = "body", strict: bool = True) -> DataFrame:
    """id, name, format, url of the resources of payloads (one JSON text per row). A payload that failed or can't be
    read stops the job with its message; ``strict=False`` leaves such payloads out."""
    p = payloads.select(F.from_json(body, _PAYLOAD).alias("p"))
    ok = F.coalesce(F.col("p.success"), F.lit(False))
    if strict:
        said = F.concat(F.lit("the catalogue gave no dataset: "), F.coalesce(F.col("p.error.message"), F.lit("unreadable answer")))
        ok = F.when(ok, True).otherwise(F.raise_error(said).cast("boolean"))
    return p.where(ok).select(F.col("p.result.id").alias("id"), F.inline("p.result.resources"))


def is_boundary(name: Column, kind: Column, url: Column) -> Column:
    """Whether a resource holds admin boundaries: by format, suffix of the URL, or a word in either."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    any_of = lambda c, words: F.coalesce(low(c).rlike("|".join(words)), F.lit(False))
    by_suffix = low(url).rlike("(" + "|".join(s.replace(".", r"\.") for s in SUFFIXES) + ")$")
    return low(kind).isin(FORMATS) | by_suffix | any_of(name, WORDS_IN_NAME) | any_of(name, WORDS) | any_of(url, WORDS)


def admin_level(path: Column) -> Column:
    """0 to 2 from a file name like adm2 or admbndp1; null for none or deeper levels."""
    n = F.regexp_extract(F.lower(path), r"adm(?:bndp|in)?(\d)", 1).try_cast("int")
    return F.when(n <= 2, n)


def links(pages: DataFrame, pattern: str, body: str = "html") -> DataFrame:
    """Distinct hrefs of listing pages that match a pattern."""
    href = F.explode(F.regexp_extract_all(F.col(body), F.lit(r'href="([^"]+)"'), F.lit(1)))
    return pages.select(href.alias("href")).where(F.col("href").rlike(pattern)).distinct()


def latest_count(payload: Column) -> Column:
    """The newest value of a count response: a plain value, the last of ``result``, or of the first group."""
    schema = "value double, count double, result array<struct<timestamp: string, value: double>>, groupByResult array<struct<result: array<struct<timestamp: string, value: double>>>>"
    p = F.from_json(payload, schema)
    grouped = F.try_element_at(F.try_element_at(p.groupByResult, F.lit(1)).result, F.lit(-1)).value
    return F.coalesce(F.try_element_at(p.result, F.lit(-1)).value, grouped, p.value, p["count"], F.lit(0.0)).cast("long")


def country_dimension(spark: SparkSession, lines: DataFrame, line: str = "value") -> DataFrame:
    """iso3, region, hdx_country from the YAML country file, one line per row in file order with ``n``."""
    x = lines.select("n", F.regexp_extract(line, r"^(\w{3}):\s*$", 1).alias("iso3"), F.regexp_extract(line, r"^\s+(\w+):\s*(.+?)\s*$", 1).alias("k"), F.regexp_extract(line, r"^\s+(\w+):\s*(.+?)\s*$", 2).alias("v"))
    block = F.last(F.nullif("iso3", F.lit("")), ignorenulls=True)
    from pyspark.sql import Window

    named = x.withColumn("iso3", block.over(Window.orderBy("n")))  # a file of a few hundred lines
    return named.where("k <> ''").groupBy("iso3").agg(F.max(F.when(F.col("k") == "region", F.trim(F.col("v"), F.lit("\"'")))).alias("region"), F.max(F.when(F.col("k") == "hdx_country", F.trim(F.col("v"), F.lit("\"'")))).alias("hdx_country"))
