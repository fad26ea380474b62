"""Star schema: dimensions with stable keys, facts, range joins and slowly changing dimensions."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelwise.functions import rules
from parcelwise.functions.columns import date_key, first_match, lookup, timestamp_of
from parcelwise.sources.store import literal_table

UNKNOWN_KEY, UNKNOWN_DATE = -1, 19000101
PRICE_SCHEMA = "price_segment_key smallint, segment_name string, price_floor decimal(15,2), price_ceiling decimal(15,2), label string, valid_from date, valid_to date, is_current boolean"
AREA_SCHEMA = "area_segment_key smallint, segment_name string, area_floor decimal(8,2), area_ceiling decimal(8,2), label string"


def keyed(members: DataFrame, natural: list[str], key: str, old: DataFrame | None = None) -> DataFrame:
    """Members with keys 1..n by their natural key. Members of ``old`` keep theirs and new ones are numbered after
    them. Dimensions are distinct values; the one-partition window numbers those, never facts."""
    if old is None:
        return members.withColumn(key, F.row_number().over(Window.orderBy(*natural)))
    match = [members[c].eqNullSafe(old[c]) for c in natural]
    fresh = members.join(old, match, "left_anti")
    top = old.agg(F.coalesce(F.max(key), F.lit(0)).alias("_top"))
    fresh = fresh.crossJoin(F.broadcast(top)).withColumn(key, F.col("_top") + F.row_number().over(Window.orderBy(*natural))).drop("_top")  # one row
    return old.unionByName(fresh, allowMissingColumns=True)


def dim_location(silver: DataFrame, regions: dict[str, str] = rules.REGIONS, old: DataFrame | None = None) -> DataFrame:
    places = silver.select("city", "district").distinct()
    places = places.select("city", "district", F.col("city").alias("city_normalized"), F.col("district").alias("district_normalized"), lookup(F.col("city"), regions, "OTHER").alias("region_code"))
    return keyed(places, ["city", "district"], "location_key", old)


def dim_property_type(silver: DataFrame, groups: dict[str, list[str]] = rules.TYPE_GROUPS, old: DataFrame | None = None) -> DataFrame:
    """Types with their group and their most frequent mapping source (ties by name)."""
    if "mapping_source" not in silver.columns:
        silver = silver.withColumn("mapping_source", F.lit("Unknown"))
    counts = silver.groupBy("property_type", "mapping_source").agg(F.count(F.lit(1)).alias("n"))
    usual = F.min_by("mapping_source", F.when(F.col("mapping_source").isNotNull(), F.struct(-F.col("n"), F.col("mapping_source"))))
    types = counts.groupBy(F.col("property_type").alias("property_type_name")).agg(usual.alias("mapping_source"))
    types = types.withColumn("property_type_group", first_match(F.col("property_type_name"), groups, "Unknown"))
    return keyed(types, ["property_type_name"], "property_type_key", old)


def dim_price_segment(spark: SparkSession) -> DataFrame:
    return literal_table(spark, rules.PRICE_SEEDS, PRICE_SCHEMA)


def dim_area_segment(spark: SparkSession) -> DataFrame:
    return literal_table(spark, rules.AREA_SEEDS, AREA_SCHEMA)


def dim_time(spark: SparkSession, start: str = "2024-01-01", end: str = "2028-12-31") -> DataFrame:
    """A row for each day, both ends included."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("interval 1 day"))).alias("full_date"))
    d, weekday = F.col("full_date"), F.weekday("full_date") + 1
    name = lambda names, i: F.element_at(F.array(*[F.lit(n) for n in names]), i)
    return days.select(
        date_key(d).alias("time_key"), "full_date", weekday.alias("day_of_week"), name(rules.DAY_NAMES, weekday).alias("day_name"), F.dayofmonth(d).alias("day_of_month"),
        F.weekofyear(d).alias("week_of_year"), F.month(d).alias("month"), name(rules.MONTH_NAMES, F.month(d)).alias("month_name"), F.quarter(d).alias("quarter"),
        F.year(d).alias("year"), (weekday >= 6).alias("is_weekend"),
    )


def with_key(facts: DataFrame, dim: DataFrame, on: dict[str, str], key: str) -> DataFrame:
    """The dimension's key by equality of fact and dimension columns, -1 where there is none. Spark broadcasts a
    dimension that it knows to be small (seeds, stored tables, :func:`parcelwise.sources.store.sized`) and shuffles
    others."""
    side = dim.select(F.col(key).alias("_key"), *[F.col(d).alias(f"_d{i}") for i, d in enumerate(on.values())])
    match = [F.col(f) == F.col(f"_d{i}") for i, f in enumerate(on)]
    return facts.join(side, match, "left").withColumn(key, F.coalesce("_key", F.lit(UNKNOWN_KEY))).drop("_key", *[f"_d{i}" for i in range(len(on))])


def in_band(value: Column, low: Column, high: Column) -> Column:
    """Half-open band; a null upper end is open."""
    return (value >= low) & (high.isNull() | (value < high))


#: Cells that one axis of a grid is cut into at most.
MOST_CELLS = 1024


def _edges(bands: DataFrame, low: str, high: str, cells: int) -> list[float]:
    """Values that cut the bands' own ends into ``cells`` equal shares; they are fewer where ends coincide. At most
    MOST_CELLS values reach the driver."""
    ends = bands.select(F.explode(F.array(F.col(low).cast("double"), F.col(high).cast("double"))).alias("e")).filter("e is not null and not isnan(e)")
    shares = [k / cells for k in range(1, cells)]
    found = ends.agg(F.percentile_approx("e", shares, 10 * cells)).first()[0] if shares else None
    return sorted(set(found or []))


def _cells(df: DataFrame, value: Column, edges: list[float], name: str) -> DataFrame:
    """The number of the cell that a value lies in, by binary search; above all edges for NaN, which sorts there, and null for
    null."""
    search = Bucketizer(splits=[-math.inf, *edges, math.inf], inputCol="_v", outputCol=name, handleInvalid="keep")
    held = df.withColumn("_v", F.when(F.isnan(value.cast("double")), math.inf).otherwise(value.cast("double")))
    return search.transform(held).withColumn(name, F.when(F.col("_v").isNotNull(), F.col(name).cast("int"))).drop("_v")


def _dealt(bands: DataFrame, low: str, high: str, edges: list[float], name: str) -> DataFrame:
    """Each band once for every cell that it touches; a null upper end is open."""
    rows = _cells(_cells(bands, F.col(low), edges, "_a"), F.col(high), edges, "_b")
    return rows.withColumn(name, F.explode(F.sequence(F.col("_a"), F.coalesce("_b", F.lit(len(edges)))))).drop("_a", "_b")


def range_join(facts: DataFrame, bands: DataFrame, value: str, low: str, high: str, columns: list[str], grid: bool = False) -> DataFrame:
    """Each fact with the columns of the bands that hold its value (one row for each, if bands overlap), or nulls.

    With few bands the comparison goes straight against them. With many, ``grid`` joins by cells: edges are taken from the
    bands' own ends, so every cell meets about as many bands, namely the square root of their number if they do not overlap,
    and no task meets all of them. There are as many cells as that root, so a band that is as wide as all others together is
    copied that often at most; the result does not depend on the cells.
    """
    side = bands.select(F.col(low).alias("_low"), F.col(high).alias("_high"), *columns)
    held = in_band(F.col(value), F.col("_low"), F.col("_high"))
    if not grid:
        return facts.join(side, held, "left").drop("_low", "_high")
    side = side.filter("_low is not null and (_high is null or _low < _high)")
    edges = _edges(side, "_low", "_high", min(MOST_CELLS, math.isqrt(side.count()) + 1))
    side = _dealt(side, "_low", "_high", edges, "_cell")
    facts = _cells(facts, F.col(value), edges, "_f")
    return facts.join(side, (F.col("_f") == F.col("_cell")) & held, "left").drop("_low", "_high", "_cell", "_f")


def half_open(dim: DataFrame, low: str, high: str) -> DataFrame:
    """Bands whose inclusive ceilings leave gaps, closed to the next floor (within each validity period, if any)."""
    group = [c for c in ("valid_from", "valid_to") if c in dim.columns]
    after = Window.partitionBy(*group).orderBy(low) if group else Window.orderBy(low)
    return dim.withColumn(high, F.lead(low).over(after))


def point_in_time_join(facts: DataFrame, dim: DataFrame, value: str, day: str, low: str, high: str, columns: list[str], grid: bool = False) -> DataFrame:
    """Each fact with the band that was valid on its day. With ``grid`` (bands times periods are many) it is joined by cells of
    value and day, each cut at the bands' own ends, as in :func:`range_join`."""
    side = dim.select(F.col(low).alias("_low"), F.col(high).alias("_high"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *columns)
    valid = (F.col("_from") <= F.col(day)) & (F.col("_to").isNull() | (F.col(day) <= F.col("_to")))
    held = in_band(F.col(value), F.col("_low"), F.col("_high")) & valid
    if not grid:
        return facts.join(side, held, "left").drop("_low", "_high", "_from", "_to")
    side = side.filter("_low is not null and (_high is null or _low < _high) and _from is not null").withColumns({"_first": F.unix_date("_from"), "_last": F.unix_date("_to")})
    cells = min(MOST_CELLS, math.isqrt(math.isqrt(side.count()) + 1) * 2)
    values, days = _edges(side, "_low", "_high", cells), _edges(side, "_first", "_last", cells)
    side = _dealt(_dealt(side, "_low", "_high", values, "_cell"), "_first", "_last", days, "_days").drop("_first", "_last")
    facts = _cells(_cells(facts, F.col(value), values, "_f"), F.unix_date(F.col(day)), days, "_d")
    return facts.join(side, (F.col("_f") == F.col("_cell")) & (F.col("_d") == F.col("_days")) & held, "left").drop("_low", "_high", "_from", "_to", "_cell", "_days", "_f", "_d")


def scd2_apply(dim: DataFrame, new: DataFrame, natural: str, tracked: list[str], effective: Column, key: str) -> DataFrame:
    """Current rows whose tracked columns differ in ``new`` are closed the day before ``effective``, and their new
    versions are added; unchanged rows stay, and new members are added."""
    side = new.select(F.col(natural).alias("_n"), *[F.col(c).alias(f"_{c}") for c in tracked])
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = dim.join(side, (F.col(natural) == F.col("_n")) & F.col("is_current"), "left")
    closes = F.col("_n").isNotNull() & differs
    closed = joined.withColumn("valid_to", F.when(closes, F.date_sub(effective, 1)).otherwise(F.col("valid_to"))).withColumn("is_current", F.col("is_current") & ~F.coalesce(closes, F.lit(False))).select(*dim.columns)
    current = dim.filter("is_current")
    same = (current[natural] == new[natural])
    for c in tracked:
        same = same & current[c].eqNullSafe(new[c])
    added = new.join(current, same, "left_anti").withColumns({"valid_from": effective, "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)})
    added = added.select(*[c for c in dim.columns if c != key and c in added.columns])
    top = dim.agg(F.max(key).alias("_top"))
    added = added.crossJoin(F.broadcast(top)).withColumn(key, (F.col("_top") + F.row_number().over(Window.orderBy(natural))).cast(dim.schema[key].dataType)).drop("_top")  # one row
    return closed.unionByName(added, allowMissingColumns=True)


def stable_key(*columns: str) -> Column:
    """A key from the natural key alone: 60 bits of its digest, the same on every run and in every engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).cast("binary")), 1, 15), 16, 10).cast("long")


#: Silver columns that dimensions are looked up by, and those that the other columns of the facts come from.
FACT_MEMBERS = ("city", "district", "property_type", "price_segment", "area_segment")
FACT_SOURCES = {"listing_key": "property_id", "posted_time_key": "posted_at", "ingested_time_key": "ingested_at", "price_vnd": "price"} | {c: c for c in ("property_id", "title", "price_billion_vnd", "area_sqm", "price_per_sqm", "bedrooms", "listing_age_days")}


def fact_listing(silver: DataFrame, location: DataFrame, property_type: DataFrame, price: DataFrame, area: DataFrame, now: Column, columns: tuple[str, ...] = ()) -> DataFrame:
    """One row for each listing, with the keys of all its dimensions. The row's own key is a hash of its natural key:
    it needs no numbering of all facts and is the same on every run. With ``columns`` only these are made, and Silver need not have
    what the others come from (FACT_SOURCES)."""
    time_key = lambda c: F.coalesce(date_key(timestamp_of(F.col(c))), F.lit(UNKNOWN_DATE)).cast("int")
    facts = with_key(silver, location, {"city": "city", "district": "district"}, "location_key")
    facts = with_key(facts, property_type, {"property_type": "property_type_name"}, "property_type_key")
    facts = with_key(facts, price, {"price_segment": "segment_name"}, "price_segment_key")
    facts = with_key(facts, area, {"area_segment": "segment_name"}, "area_segment_key")
    money = lambda c, t: F.col(c).try_cast(t)
    made = {
        "listing_key": stable_key("property_id"), "property_id": F.col("property_id"), **{c: F.col(c).cast("int") for c in ("location_key", "property_type_key", "price_segment_key", "area_segment_key")},
        "posted_time_key": time_key("posted_at"), "ingested_time_key": time_key("ingested_at"), "title": F.col("title"), "price_vnd": money("price", "decimal(15,2)"), "price_billion_vnd": money("price_billion_vnd", "decimal(8,3)"),
        "area_sqm": money("area_sqm", "decimal(8,2)"), "price_per_sqm": money("price_per_sqm", "decimal(15,2)"), "bedrooms": money("bedrooms", "smallint"), "listing_age_days": F.col("listing_age_days").cast("int"), "created_at": now, "updated_at": now,
    }
    return facts.select(*[made[c].alias(c) for c in columns or made])


def fact_market_snapshot(gold: DataFrame, location: DataFrame) -> DataFrame:
    """One row for each place and snapshot."""
    at = timestamp_of(F.col("snapshot_at"))
    facts = with_key(gold, location, {"city": "city", "district": "district"}, "location_key")
    facts = facts.withColumn("snapshot_time_key", F.coalesce(date_key(at), F.lit(UNKNOWN_DATE)))
    kinds = {"avg_price": "decimal(15,2)", "median_price": "decimal(15,2)", "p90_price": "decimal(15,2)", "avg_area_sqm": "decimal(8,2)", "avg_price_per_sqm": "decimal(15,2)", "p90_price_per_sqm": "decimal(15,2)", "max_price": "decimal(15,2)", "min_price": "decimal(15,2)", "avg_listing_age_days": "decimal(6,2)", "luxury_listing_ratio": "decimal(5,4)"}
    return facts.select(stable_key("location_key", "snapshot_time_key").alias("snapshot_key"), F.col("location_key").cast("int"), F.col("snapshot_time_key").cast("int"), F.col("listing_count").cast("int"), *[F.col(c).try_cast(t).alias(c) for c, t in kinds.items()], at.alias("snapshot_at"))
