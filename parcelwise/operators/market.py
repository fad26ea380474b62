"""Silver features, the Gold market snapshot, outliers, threshold advice and training features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.functions import rules
from parcelwise.functions.columns import Rounder, band, searched, timestamp_of


def to_silver(df: DataFrame, as_of: Column, rounder: Rounder = F.round, nulls_last_band: bool = True) -> DataFrame:
    """Listings with price and area features; ``as_of`` is the clock."""
    posted = timestamp_of(F.col("posted_at"))
    return df.withColumns(
        {
            "price_billion_vnd": rounder(F.col("price") / 1e9, 3),
            "price_per_sqm": rounder(F.try_divide("price", "area_sqm"), 2),
            "price_segment": band(F.col("price"), rules.PRICE_BANDS, nulls_last_band),
            "area_segment": band(F.col("area_sqm"), rules.AREA_BANDS, nulls_last_band),
            "posted_date": F.to_date(posted).cast("string"),
            "listing_age_days": F.greatest(F.lit(0), F.datediff(as_of, posted)),
            "ingested_at": F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss"),
        }
    )


def to_gold(silver: DataFrame, as_of: Column, rounder: Rounder = F.round, accuracy: int = 10_000, keys: tuple[str, ...] = ("city", "district")) -> DataFrame:
    """One row for each place: counts, means, percentiles and the share of luxury listings."""
    n = F.count(F.lit(1))
    pick = lambda c, p: rounder(F.percentile_approx(c, p, accuracy), 2)
    return silver.groupBy(*keys).agg(
        n.alias("listing_count"),
        rounder(F.avg("price"), 2).alias("avg_price"),
        rounder(F.avg("area_sqm"), 2).alias("avg_area_sqm"),
        rounder(F.avg("price_per_sqm"), 2).alias("avg_price_per_sqm"),
        pick("price", 0.5).alias("median_price"),
        pick("price", 0.9).alias("p90_price"),
        pick("price_per_sqm", 0.9).alias("p90_price_per_sqm"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        rounder(F.sum("listing_age_days") / n, 2).alias("avg_listing_age_days"),
        rounder(F.sum(F.when(F.col("price_segment") == "luxury", 1).otherwise(0)) / n, 4).alias("luxury_listing_ratio"),
        F.date_format(F.first(as_of), "yyyy-MM-dd'T'HH:mm:ss").alias("snapshot_at"),
    )


def touched_gold(silver_all: DataFrame, batch: DataFrame, as_of: Column, keys: tuple[str, ...] = ("city", "district"), **how) -> DataFrame:
    """Gold of the places that a batch touches, from all of Silver."""
    places = batch.select(*keys).distinct()
    match = [silver_all[k].eqNullSafe(places[k]) for k in keys]
    return to_gold(silver_all.join(places, match, "left_semi"), as_of, keys=keys, **how)


#: Values that a quantile sketch keeps a level; the rank error of about 1.3 / SKETCH stays under half a percent.
SKETCH = 400
MEASURES = ("price", "price_per_sqm")


def gold_cells(silver: DataFrame, keys: tuple[str, ...] = ("city", "district"), day: str = "posted_date") -> DataFrame:
    """Sums, extremes and quantile sketches of each place and day. They add up: any set of cells gives the Gold row of all their
    listings (:func:`gold_of_cells`), so a batch has only the cells made anew that its listings are or were in."""
    some = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    return silver.groupBy(*keys, day).agg(
        F.count(F.lit(1)).alias("n"),
        *[x for c in ("price", "area_sqm", "price_per_sqm") for x in (F.count(c).alias(f"n_{c}"), F.sum(c).alias(f"sum_{c}"))],
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        F.count_if(F.col("price_segment") == "luxury").alias("n_luxury"),
        *[F.kll_sketch_agg_double(F.when(some(c), F.col(c)), SKETCH).alias(f"sketch_{c}") for c in MEASURES],
    )


def gold_of_cells(cells: DataFrame, as_of: Column, rounder: Rounder = F.round, keys: tuple[str, ...] = ("city", "district"), day: str = "posted_date") -> DataFrame:
    """Gold rows from cells, for places or for what ``keys`` rolls them up to. Counts, means, extremes and ages are those of
    :func:`to_gold`; quantiles have the rank error of the sketches."""
    n = F.sum("n")
    mean = lambda c: rounder(F.sum(f"sum_{c}") / F.nullif(F.sum(f"n_{c}"), F.lit(0)), 2)
    merged = {c: F.kll_merge_agg_double(f"sketch_{c}", SKETCH) for c in MEASURES}
    pick = lambda c, p: F.when(F.sum(f"n_{c}") > 0, rounder(F.kll_sketch_get_quantile_double(merged[c], F.lit(p)), 2))
    age = F.greatest(F.lit(0), F.datediff(as_of, F.to_date(day)))
    return cells.groupBy(*keys).agg(
        n.alias("listing_count"),
        mean("price").alias("avg_price"),
        mean("area_sqm").alias("avg_area_sqm"),
        mean("price_per_sqm").alias("avg_price_per_sqm"),
        pick("price", 0.5).alias("median_price"),
        pick("price", 0.9).alias("p90_price"),
        pick("price_per_sqm", 0.9).alias("p90_price_per_sqm"),
        F.max("max_price").alias("max_price"),
        F.min("min_price").alias("min_price"),
        rounder(F.sum(age * F.col("n")) / n, 2).alias("avg_listing_age_days"),
        rounder(F.sum("n_luxury") / n, 4).alias("luxury_listing_ratio"),
        F.date_format(F.first(as_of), "yyyy-MM-dd'T'HH:mm:ss").alias("snapshot_at"),
    )


def cells_of_batch(silver: DataFrame, touched: DataFrame, keys: tuple[str, ...] = ("city", "district"), day: str = "posted_date") -> DataFrame:
    """The cells that a batch touches, made anew. ``touched`` (keys, day) names those that its listings are in and were in; of Silver
    only their rows are aggregated. A touched cell that has no listing any more has no row."""
    names = [*keys, day]
    own = touched.select(*names).distinct()
    return gold_cells(silver.join(own, [silver[c].eqNullSafe(own[c]) for c in names], "left_semi"), keys, day)


def exact_quantiles(df: DataFrame, value: str, shares: list[float], group: str | None = None) -> DataFrame:
    """(group, n, q): interpolated quantiles of the values that are not null, exact, for each group (or for all rows).

    Equal values are counted first. Those counts are added up in steps of one percent of the value, which say in which
    steps the wanted ranks lie, and only the values of these steps are ranked, each step by itself: no task sees all
    values of a group. A group without values has no row; NaN counts as null.
    """
    kept = df.select((F.lit(0) if group is None else F.col(group)).alias("_g"), F.col(value).cast("double").alias("_v"))
    values = kept.filter("_v is not null and not isnan(_v)").groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c"))
    size = F.floor((F.log2(F.abs("_v")) + 1100) * 64)  # grows with the value's size, from the smallest double on
    values = values.withColumn("_b", F.when(F.col("_v") == 0, 0).when(F.col("_v") > 0, size).otherwise(-size))
    steps, whole = Window.partitionBy("_g").orderBy("_b"), Window.partitionBy("_g")
    counts = values.groupBy("_g", "_b").agg(F.sum("_c").alias("_c"))
    counts = counts.select("_g", "_b", (F.sum("_c").over(steps) - F.col("_c")).alias("_from"), "_c", F.sum("_c").over(whole).alias("_n"))
    places = [F.lit(s) * (F.col("_n") - 1) for s in shares]
    ranks = [f(p) for p in places for f in (F.floor, F.ceil)]
    inside = lambda r: (F.col("_from") <= r) & (r < F.col("_from") + F.col("_c"))
    wanted = counts.filter(F.exists(F.array(*ranks), inside)).select(F.col("_g").alias("_wg"), F.col("_b").alias("_wb"), F.col("_from").alias("_before"), "_n")
    found = values.join(wanted, F.col("_g").eqNullSafe(F.col("_wg")) & (F.col("_b") == F.col("_wb")))
    ranked = Window.partitionBy("_g", "_b").orderBy("_v")
    found = found.withColumn("_from", F.col("_before") + F.sum("_c").over(ranked) - F.col("_c"))
    edges = found.groupBy("_g", "_n").agg(*[F.max(F.when(inside(r), F.col("_v"))).alias(f"_r{i}") for i, r in enumerate(ranks)])
    between = lambda i, p: (F.ceil(p) - p) * F.col(f"_r{2 * i}") + (p - F.floor(p)) * F.col(f"_r{2 * i + 1}")
    q = [F.when(F.col(f"_r{2 * i}") == F.col(f"_r{2 * i + 1}"), F.col(f"_r{2 * i}")).otherwise(between(i, p)) for i, p in enumerate(places)]
    out = edges.select(F.col("_g").alias(group or "_g"), F.col("_n").alias("n"), F.array(*q).alias("q"))
    return out if group else out.drop("_g")


def remove_outliers(df: DataFrame, group: str, value: str, k: float = 3.0, least: int = 10) -> DataFrame:
    """Rows above the upper fence Q3 + k IQR of their group go. The fence comes from positive values; groups with
    fewer than ``least`` of them, and rows that are null or zero, stay."""
    fences = exact_quantiles(df.filter(F.col(value) > 0), value, [0.25, 0.75], group)
    fences = fences.select(F.col(group).alias("_g"), F.when(F.col("n") >= least, F.col("q")[1] + k * (F.col("q")[1] - F.col("q")[0])).alias("_fence"))
    kept = F.col("_fence").isNull() | (F.col(value) <= F.col("_fence")) | F.col(value).isNull() | (F.col(value) == 0)
    return df.join(fences, df[group].eqNullSafe(fences["_g"]), "left").filter(kept).drop("_g", "_fence")


def suggest_thresholds(df: DataFrame, value: str = "price", where: Column | None = None, accuracy: int = 10_000, rounder: Rounder = F.round) -> DataFrame:
    """Quantiles .25, .5, .75 and .95 in billions, and how many rows they come from."""
    picked = df if where is None else df.filter(where)
    q = F.percentile_approx(value, F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75, 0.95)]), accuracy)
    return picked.agg(F.count(value).alias("n"), q.alias("q")).select("n", *[rounder(F.col("q")[i] / 1e9, 1).alias(c) for i, c in enumerate(("q25", "q50", "q75", "q95"))])


def weak_label(df: DataFrame, tiers: list[tuple[str, str, str, float]], name: str, confidence: str, unknown: tuple[str, float], category: str = "source_category", title: str = "title") -> DataFrame:
    """A label and its confidence from ordered patterns on category, title or both."""
    inputs = {"source_category": F.lower(category), "title": F.lower(title), "both": F.concat_ws(" ", F.lower(category), F.lower(title))}
    label = sure = None
    for what, pattern, value, c in tiers:
        hit = searched(F.coalesce(inputs[what], F.lit("")), pattern)
        label = F.when(hit, value) if label is None else label.when(hit, value)
        sure = F.when(hit, c) if sure is None else sure.when(hit, c)
    return df.withColumns({name: label.otherwise(unknown[0]), confidence: sure.otherwise(unknown[1])})


def build_features(df: DataFrame, flags: dict[str, str] = rules.TITLE_FLAGS) -> DataFrame:
    """Numbers and flags for the classifiers; missing bedrooms are -1."""
    price, area = F.coalesce(F.col("price").try_cast("double"), F.lit(0.0)), F.coalesce(F.col("area_sqm").try_cast("double"), F.lit(0.0))
    beds = F.coalesce(F.col("bedrooms").try_cast("int"), F.lit(-1))
    title = F.lower(F.coalesce(F.col("title"), F.lit("")))
    per = lambda a, b: F.when(b > 0, F.try_divide(a, b)).otherwise(0.0)
    return df.withColumns(
        {
            "price_double": price, "area_double": area, "bedrooms_int": beds, "log_price": F.log1p(price), "title_length": F.length(title),
            "price_per_sqm": per(price, area), "price_per_bedroom": per(price, beds), "area_per_bedroom": per(area, beds),
            "price_hint_rent": price.between(1, 500_000_000).cast("int"),
            **{c: searched(title, p).cast("int") for c, p in flags.items()},
            "is_missing_bedroom": (beds == -1).cast("int"), "is_missing_price": (price == 0).cast("int"),
        }
    )


def group_means(train: DataFrame, group: str, value: str, name: str = "district_avg_price") -> DataFrame:
    """Mean of the positive values of each group, to be kept with the model."""
    return train.filter(F.col(value) > 0).groupBy(group).agg(F.avg(value).alias(name))


def with_group_mean(df: DataFrame, means: DataFrame, group: str, name: str = "district_avg_price") -> DataFrame:
    """The group's mean from training, 0 for groups that were not there."""
    return df.join(means.withColumnRenamed(group, "_g"), F.col(group) == F.col("_g"), "left").drop("_g").fillna(0.0, [name])


def training_set(df: DataFrame, listing_tiers=rules.LISTING_TIERS, property_tiers=rules.PROPERTY_TIERS, flags=rules.TITLE_FLAGS, least_title: int = 10, least_confidence: float = 0.7) -> DataFrame:
    """Titles that are long enough, first of near duplicates, priced or sized rows, without outliers, with both labels
    sure enough, and features."""
    from parcelwise.operators.cleaning import drop_near_duplicates

    rows = df.filter(F.length("title") > least_title)
    rows = drop_near_duplicates(rows)
    rows = rows.filter((F.coalesce("price", F.lit(0.0)) != 0) | (F.coalesce("area_sqm", F.lit(0.0)) != 0))
    rows = remove_outliers(rows, "city", "price")
    rows = weak_label(rows, listing_tiers, "listing_type", "listing_confidence", ("UNKNOWN", 0.30))
    rows = weak_label(rows, property_tiers, "property_type", "property_confidence", ("UNMAPPED", 0.0))
    sure = (F.col("listing_type") != "UNKNOWN") & (F.col("property_type") != "UNMAPPED") & (F.col("listing_confidence") >= least_confidence) & (F.col("property_confidence") >= least_confidence)
    return build_features(rows.filter(sure), flags)
