"""City dimension and the cascade that finds a record's city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rx

#: Kilometres of a degree, as the results to be matched have it.
KM_A_DEGREE = 111.0


def cities(geonames: DataFrame, countries: DataFrame, least: int = 20_000) -> DataFrame:
    """``cc, name, lat, lon, population, rank`` from ``geonames(ord, name, lat, lon, cc, population)``: the largest of a name in a country.

    Of equally large places of a country the one whose name comes first in the list ranks first.
    """
    fit = geonames.filter(
        (F.col("population") >= least) & (F.coalesce("name", F.lit("")) != "")
    ).join(F.broadcast(countries.select("cc")), "cc")
    best = fit.groupBy("cc", F.lower("name").alias("low")).agg(
        F.max_by(F.struct("name", "lat", "lon", "population"), F.struct("population", -F.col("ord"))).alias("x"),
        F.min("ord").alias("ord"),
    )
    rank = F.row_number().over(Window.partitionBy("cc").orderBy(F.desc("x.population"), "ord"))  # a country's cities
    return best.select("cc", "x.*", rank.alias("rank"))


def by_plain_name(dimension: DataFrame) -> DataFrame:
    """``cc, plain, city``: the city of each accent-free name; of several the smallest."""
    return dimension.groupBy("cc", rx.strip_accents(F.col("name")).alias("plain")).agg(F.max_by("name", "rank").alias("city"))


def coordinates(geonames: DataFrame, dimension: DataFrame) -> DataFrame:
    """``cc, city, lat, lon, ord``: every place of the list that has a city's name in its country, however small."""
    there = geonames.withColumn("plain", rx.strip_accents(F.col("name")))
    return there.join(by_plain_name(dimension), ["cc", "plain"]).select("cc", "city", "lat", "lon", "ord")


def distance_km(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on a plane with meridians drawn together by the cosine of the latitude."""
    x = (lon2 - lon) * F.cos(F.radians(lat)) * KM_A_DEGREE
    y = (lat2 - lat) * KM_A_DEGREE
    return F.sqrt(x * x + y * y)


def nearest(points: DataFrame, there: DataFrame, key: list[str], within: float = 30.0) -> DataFrame:
    """``key, city, km``: the city of the nearest of ``there(cc, city, lat, lon, ord)`` in the same country closer than ``within`` km, the first of equals.

    Places go into cells as wide as the limit in latitude and, at the latitude of their band that is furthest from the
    equator, in longitude; a point meets the nine cells around it, so the join is an equality.
    """
    step = within / KM_A_DEGREE
    band = F.floor(F.col("lat") / step)

    def across(lon: Column, cell: Column) -> Column:
        far = F.least(F.greatest(F.abs(cell - 1), F.abs(cell + 2)) * step, F.lit(89.0))
        return F.floor(lon / (step / F.cos(F.radians(far))))

    near = points.withColumn("cell", F.explode(F.array(band - 1, band, band + 1)))
    near = near.withColumn(
        "side",
        F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: across(F.col("lon"), F.col("cell")) + d)),
    ).alias("p")
    place = there.withColumn("cell", band).withColumn("side", across(F.col("lon"), F.col("cell"))).alias("c")
    km = distance_km(F.col("p.lat"), F.col("p.lon"), F.col("c.lat"), F.col("c.lon"))
    met = near.join(place, ["cc", "cell", "side"]).select(
        *(F.col(f"p.{k}") for k in key),
        "c.city",
        km.alias("km"),
        "c.ord",
    ).filter(F.col("km") < within)
    return met.groupBy(*key).agg(F.min_by(F.struct("city", "km"), F.struct("km", "ord")).alias("x")).select(*key, "x.city", "x.km")


def _flat(c: Column) -> Column:
    return F.trim(F.regexp_replace(rx.strip_accents(c), "[^a-z0-9]+", " "))


def named_in(records: DataFrame, dimension: DataFrame, key: list[str], least: int = 4) -> DataFrame:
    """``key, city``: the longest city name that a record's name has as whole words, of equally long ones the first by rank.

    Every stretch of a name's words, up to the words of the country's longest city name, is looked up as a whole, so a
    word that many cities or clubs begin with brings no rows together.
    """
    flat = _flat(F.col("name"))
    city = dimension.select("cc", "name", "rank", flat.alias("phrase")).filter(F.char_length("phrase") >= least)
    longest = city.groupBy("cc").agg(F.max(F.size(F.split("phrase", " "))).alias("most"))
    words = records.select(*key, "cc", F.split(flat, " ").alias("w")).join(longest, "cc")
    starts = F.sequence(F.lit(1), F.size("w"))
    stretches = F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.least(F.col("most"), F.size("w") - i + 1)), lambda n: F.array_join(F.slice("w", i, n), " ")))
    phrase = words.select(*key, "cc", F.explode(F.array_distinct(F.flatten(stretches))).alias("phrase"))
    met = phrase.filter(F.char_length("phrase") >= least).join(city, ["cc", "phrase"])
    return met.groupBy(*key).agg(F.max_by("name", F.struct(F.char_length("phrase"), -F.col("rank"))).alias("city"))


def place(records: DataFrame, geonames: DataFrame, countries: DataFrame) -> DataFrame:
    """``key, city, method`` for records ``key, cc, name, town, lat, lon, city``: own, town, name, near or none."""
    dimension = cities(geonames, countries)
    town = by_plain_name(dimension).withColumnRenamed("city", "by_town")
    with_town = records.withColumn("plain", rx.strip_accents(F.col("town"))).join(town, ["cc", "plain"], "left")
    out = with_town.join(named_in(records, dimension, ["key"]).withColumnRenamed("city", "by_name"), "key", "left")
    points = records.filter("lat is not null and lon is not null").select("key", "cc", "lat", "lon")
    near = nearest(points, coordinates(geonames, dimension), ["key"]).select("key", F.col("city").alias("by_place"))
    out = out.join(near, "key", "left")
    own = F.nullif(F.coalesce("city", F.lit("")), F.lit(""))
    method = F.when(own.isNotNull(), "own").when(F.col("by_town").isNotNull(), "town").when(F.col("by_name").isNotNull(), "name").when(F.col("by_place").isNotNull(), "near").otherwise("none")
    return out.select("key", F.coalesce(own, "by_town", "by_name", "by_place").alias("city"), method.alias("method"))
