"""Validation, standardisation, classification and dedup of listings."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.functions import rules
from parcelwise.functions.columns import Rounder, contains_one, last_match, squeezed, timestamp_of
from parcelwise.sources.store import literal_table

REQUIRED = ("property_id", "city", "district", "price", "area_sqm", "bedrooms", "posted_at")
#: Column, type and the smallest value allowed (exclusive, or inclusive with True).
NUMERIC = (("price", "double", 0, False), ("area_sqm", "double", 0, False), ("bedrooms", "int", 0, True))


def ensure_columns(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Columns that are missing, with a default."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def with_reason(df: DataFrame, required=REQUIRED, numeric=NUMERIC, name: str = "dq_reason") -> DataFrame:
    """The first rule that a row breaks: a required field missing or blank, a cast, a range; null if it breaks none.

    NaN counts as a failed cast. The reason is taken out of an array of one, so a filter on it is not moved below what the
    columns are made of, which Spark would then work out again for each of their uses here.
    """
    missing = F.lit(False)
    for c in required:
        missing = missing | F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")).eqNullSafe("")
    failed, outside = F.lit(False), F.lit(False)
    numbers = {f"_number_{c}": F.col(c).try_cast(kind) for c, kind, _, _ in numeric}  # cast once each
    for c, kind, least, inclusive in numeric:
        number = F.col(f"_number_{c}")
        failed = failed | number.isNull() | (F.isnan(number) if kind == "double" else F.lit(False))
        outside = outside | ((number < least) if inclusive else (number <= least))
    reason = F.when(missing, "missing_required_fields").when(failed, "type_cast_failed").when(outside, "numeric_constraint_failed")
    return df.withColumns(numbers).withColumn(name, F.explode(F.array(reason))).drop(*numbers)


def validate(df: DataFrame, required=REQUIRED, numeric=NUMERIC) -> tuple[DataFrame, DataFrame]:
    """(valid rows as they came, invalid rows with their reason); both are filters over one lazy frame."""
    tagged = with_reason(df, required, numeric)
    return tagged.filter("dq_reason is null").drop("dq_reason"), tagged.filter("dq_reason is not null")


def only_valid(df: DataFrame, required=REQUIRED, numeric=NUMERIC) -> DataFrame:
    """The valid rows of :func:`validate`, for plans that do not read the numbers afterwards: each number is a condition of its own,
    which Spark moves below joins to the table that it comes from, so that its columns stay there. (A blank is no number.)"""
    for c, kind, least, inclusive in numeric:
        number = F.col(c).try_cast(kind)
        number = F.nanvl(number, F.lit(None).cast(kind)) if kind == "double" else number
        df = df.filter(number >= least if inclusive else number > least)
    texts = tuple(c for c in required if c not in {n[0] for n in numeric})
    return with_reason(df, texts, ()).filter("dq_reason is null").drop("dq_reason")


def reason_counts(tagged: DataFrame) -> DataFrame:
    return tagged.filter("dq_reason is not null").groupBy("dq_reason").agg(F.count(F.lit(1)).alias("n"))


def quality_metrics(tagged: DataFrame) -> DataFrame:
    """One row: total, valid, invalid and the share of invalid rows (4 decimals, 0 for an empty table)."""
    total, bad = F.count(F.lit(1)), F.count("dq_reason")
    return tagged.agg(total.alias("total"), (total - bad).alias("valid"), bad.alias("invalid"), F.when(total > 0, F.floor(bad / total * 10000 + 0.5) / 10000).otherwise(0.0).alias("invalid_rate"))


def invalid_samples(tagged: DataFrame, order: list[str], n: int = 20) -> DataFrame:
    return tagged.filter("dq_reason is not null").orderBy(*order).limit(n)


def quality_report(tagged: DataFrame, order: list[str], dropped: DataFrame | None = None, n: int = 20) -> DataFrame:
    """One row to be published: the metrics, ``reasons`` (how many rows each rule caught) and ``samples``, the first ``n`` invalid
    rows in the given order; with ``dropped`` also its counts of records that did not come this far."""
    few = [c for c in dict.fromkeys([*order, "title", "price", "area_sqm"]) if c in tagged.columns]
    reasons = reason_counts(tagged).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("dq_reason", "n")))).alias("reasons"))
    samples = invalid_samples(tagged.select(*few, "dq_reason"), few, n).agg(F.sort_array(F.collect_list(F.struct(*few, "dq_reason"))).alias("samples"))
    report = quality_metrics(tagged).crossJoin(F.broadcast(reasons)).crossJoin(F.broadcast(samples))  # one row each
    return report if dropped is None else report.crossJoin(F.broadcast(dropped))


def alias_table(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """(alias, standard), lower case, one row for each alias (the first standard wins), of a size that Spark knows."""
    pairs, seen = [], set()
    for standard, names in aliases.items():
        for name in [standard, *names]:
            if name.lower() not in seen:
                seen.add(name.lower())
                pairs.append((name.lower(), standard))
    return literal_table(df.sparkSession, pairs, "alias string, standard string")


def scoped_table(df: DataFrame, aliases: dict[tuple[str | None, str], list[str]]) -> DataFrame:
    """(scope, alias, standard) of rules that hold within a standard of another column, or, with a null scope, everywhere."""
    pairs = {}
    for (scope, standard), names in aliases.items():
        for name in [standard, *names]:
            pairs.setdefault((scope, name.lower()), standard)
    return literal_table(df.sparkSession, [(scope, alias, standard) for (scope, alias), standard in pairs.items()], "scope string, alias string, standard string")


def standardize(df: DataFrame, tables: dict[str, DataFrame | dict[str, list[str]]], scopes: dict[str, str] | None = None) -> DataFrame:
    """Columns replaced by their standard names; ``mapping_status`` is MAPPED only if all of them were found, and a
    value that was not found keeps its text. Tables are joined, so they may grow: Spark broadcasts those it knows to be
    small (dicts, and tables read from files) and shuffles others.

    ``scopes`` names, for a column, an earlier one whose standard its aliases may depend on: of a table with ``scope``
    (:func:`scoped_table`) the rule for that standard is taken first, and else the one without scope. So two cities may
    map one district alias apart. A table without ``scope`` holds everywhere."""
    hits: list[Column] = []
    made = []
    for column, table in tables.items():
        pairs = alias_table(df, table) if isinstance(table, dict) else table
        own, found = f"_{column}_alias", [f"_{column}_standard"]
        df = df.withColumn(column, squeezed(F.col(column)))
        if scopes and column in scopes and "scope" in pairs.columns:
            outer = F.coalesce(f"_{scopes[column]}_standard", scopes[column])
            narrow = pairs.filter("scope is not null").select(F.col("scope").alias(f"_{column}_scope"), F.col("alias").alias(f"_{column}_narrow"), F.col("standard").alias(f"_{column}_nearest"))
            df = df.join(narrow, (F.lower(F.col(column)) == F.col(f"_{column}_narrow")) & (outer == F.col(f"_{column}_scope")), "left")
            found.insert(0, f"_{column}_nearest")
            made += narrow.columns
        wide = pairs.filter("scope is null") if "scope" in pairs.columns else pairs
        wide = wide.select(F.col("alias").alias(own), F.col("standard").alias(f"_{column}_wide"))
        df = df.join(wide, F.lower(F.col(column)) == F.col(own), "left")
        df = df.withColumn(f"_{column}_standard", F.coalesce(*[c for c in found if c != f"_{column}_standard"], f"_{column}_wide"))
        made += [own, f"_{column}_wide", f"_{column}_standard"]
        hits.append(F.col(f"_{column}_standard").isNotNull())
    status = hits[0]
    for h in hits[1:]:
        status = status & h
    df = df.withColumn("mapping_status", F.when(status, "MAPPED").otherwise("UNMAPPED"))
    return df.withColumns({c: F.coalesce(f"_{c}_standard", c) for c in tables}).drop(*made)


def clean_records(df: DataFrame, tables: dict[str, DataFrame | dict[str, list[str]]], keywords: dict[str, list[str]] | None = rules.TYPE_KEYWORDS, unknown: str = rules.UNKNOWN_TYPE, other: str = rules.OTHER_SOURCE, rounder: Rounder = F.round) -> DataFrame:
    """Raw valid rows as clean ones: places standardised (``mapping_status``), price and area as numbers of two decimals,
    bedrooms as a whole number that is no less than 0 (and 0 if there is none), a property type from keywords, and the
    latest row of each listing. A model's label for the rest comes after it (:func:`route_by_confidence`)."""
    df = standardize(df, tables)
    number = lambda c: rounder(F.col(c).try_cast("double"), 2)
    df = df.withColumns({"price": number("price"), "area_sqm": number("area_sqm"), "bedrooms": F.greatest(F.lit(0), F.col("bedrooms").try_cast("int"))})
    if keywords is not None:
        df = classify_by_keywords(df, keywords, unknown, other)
    return dedupe_latest(df)


def reprocess_quarantine(new: DataFrame, quarantine: DataFrame | None, clean: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(mapped rows that go on, unmapped rows that are the next quarantine) of new and quarantined rows together."""
    both = new if quarantine is None else new.unionByName(quarantine, allowMissingColumns=True)
    done = clean(both.drop("mapping_status"))
    return done.filter("mapping_status = 'MAPPED'"), done.filter("mapping_status = 'UNMAPPED'")


def classify_by_keywords(df: DataFrame, keywords: dict[str, list[str]] = rules.TYPE_KEYWORDS, unknown: str = rules.UNKNOWN_TYPE, other: str = rules.OTHER_SOURCE, label_source: bool = False) -> DataFrame:
    """``property_type`` from the title's keywords, else the source category's, else the source category itself; and
    ``mapping_source``, which says "Source" for the last case only with ``label_source``."""
    df = ensure_columns(df, {"source_category": other})
    by_title, by_source = (last_match(F.col(c), keywords, F.lit(None).cast("string")) for c in ("title", "source_category"))
    raw = F.when(F.col("source_category").isNotNull() & ~F.col("source_category").isin(other, ""), F.col("source_category"))
    source = F.when(by_title.isNotNull(), rules.FROM_TITLE).when(by_source.isNotNull(), rules.FROM_SOURCE)
    if label_source:
        source = source.when(raw.isNotNull(), "Source")
    return df.withColumns({"property_type": F.coalesce(by_title, by_source, raw, F.lit(unknown)), "mapping_source": source.otherwise(rules.FROM_MODEL_LATER)})


def route_by_confidence(df: DataFrame, label: str, confidence: str, threshold: float = 0.70, unknown: str = rules.UNKNOWN_TYPE) -> DataFrame:
    """Rows that keywords left unknown take the model's label if it is sure enough, else stay unknown."""
    open_ = F.col("property_type") == unknown
    sure = F.coalesce((F.col(confidence) >= threshold) & F.col(label).isNotNull(), F.lit(False))
    text = F.concat(F.lit("ML Model ("), F.format_string("%.0f%%", F.col(confidence) * 100), F.lit(")"))
    return df.withColumns(
        {"property_type": F.when(open_ & sure, F.col(label)).otherwise(F.col("property_type")), "mapping_source": F.when(open_ & sure, text).when(open_, rules.FROM_MODEL_NEVER).otherwise(F.col("mapping_source"))}
    )


def listing_type(df: DataFrame, label: str, confidence: str, threshold: float = 0.70) -> DataFrame:
    sure = (F.col(confidence) >= threshold) & F.col(label).isNotNull()
    return df.withColumn("listing_type", F.when(sure, F.col(label)).otherwise("UNKNOWN"))


def dedupe_latest(df: DataFrame, key: str = "property_id", order: Column | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """The latest row of each key; ties go by all columns, so the result does not depend on how rows arrive. ``within`` names
    columns that the key decides, so that rows which are dealt by them already are not shuffled again."""
    latest = F.unix_micros(timestamp_of(F.col("posted_at"))) if order is None else order
    return _first_of(df, [*within, key], [latest])


def newest_version(df: DataFrame, key: str, versions: list[str], posted: str = "posted_at") -> DataFrame:
    """The row of each key with the highest numbers in ``versions`` (in this order, null lowest), then the latest time, then
    by all columns."""
    return _first_of(df, [key], [*[F.col(v) for v in versions], F.unix_micros(timestamp_of(F.col(posted)))])


def _first_of(df: DataFrame, keys: list[str], highest: list[Column]) -> DataFrame:
    """Of each key the row that comes first. Spark drops the others of a task as soon as they are sorted, so one row of a key in
    each task is shuffled; the least of a struct (``min_by``) takes twice the time, as its buffers are rebuilt row by row."""
    named = {f"_o{i}": x for i, x in enumerate(highest)}
    first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in named], *[F.col(c).asc_nulls_last() for c in df.columns])
    return df.withColumns(named).withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn", *named)


def drop_near_duplicates(df: DataFrame, title: str = "title", price: str = "price", order: str = "property_id", prefix: int = 50) -> DataFrame:
    """The first of the rows that share the beginning of the title and the price; nulls count as equal."""
    same = Window.partitionBy(F.substring(title, 1, prefix), price).orderBy(order, *[F.col(c).asc_nulls_last() for c in df.columns])
    return df.withColumn("_rn", F.row_number().over(same)).filter("_rn = 1").drop("_rn")


def similar_texts(texts: DataFrame, group: str, text: str, most: float) -> DataFrame:
    """(group, a, b, d) of all pairs a < b of different texts of a group whose edit distance is at most ``most`` (below 1)
    of the longer one's length; ``d`` is that share.

    An edit spoils ``q`` runs of ``q`` letters at most, so of any k q + 1 different runs of a text, one is also in every text
    within k edits of it: texts meet by the k q + 1 rarest of their runs (a prefix in an order by how many texts hold a run),
    and only those that meet, and whose lengths are near enough, are compared. Texts with fewer runs than that also meet
    every text of a near length.
    """
    q = 2 if most < 0.4 else 1
    t = texts.select(F.col(group).alias("g"), F.col(text).alias("t")).distinct().withColumn("n", F.length("t"))
    edits = F.floor(F.floor(F.col("n") / (1 - most) + 1e-9) * most + 1e-9)  # in a pair with the longest text that may be near
    t = t.withColumn("need", edits * q + 1)
    runs = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.col("n") - q + 1, F.lit(1))), lambda i: F.substring(F.col("t"), i, F.lit(q))))
    t = t.withColumn("runs", F.when(F.col("n") >= q, runs).otherwise(F.expr("cast(array() as array<string>)")))
    each = t.select("g", "t", "n", "need", F.explode("runs").alias("run"))
    often = each.groupBy("run").agg(F.count(F.lit(1)).alias("often"))
    rarest = Window.partitionBy("g", "t").orderBy("often", "run")
    keyed = each.join(often.withColumnRenamed("run", "_run"), F.col("run") == F.col("_run")).withColumn("_r", F.row_number().over(rarest)).filter("_r <= need").select("g", "t", "n", "run")
    pick = lambda d, side: d.select(*[F.col(c).alias(f"{side}{c}") for c in ("g", "t", "n", "run")])
    near = (F.col("yn") - F.floor(F.greatest("xn", "yn") * most + 1e-9) <= F.col("xn")) & (F.col("xn") - F.floor(F.greatest("xn", "yn") * most + 1e-9) <= F.col("yn"))
    met = pick(keyed, "x").join(pick(keyed, "y"), (F.col("xg") == F.col("yg")) & (F.col("xrun") == F.col("yrun")) & (F.col("xt") < F.col("yt")) & near)
    # Texts of few runs go to all lengths that may be near.
    few = t.filter(F.size("runs") < F.col("need")).withColumn("at", F.explode(F.sequence(F.ceil(F.col("n") * (1 - most) - 1e-9), F.floor(F.col("n") / (1 - most) + 1e-9))))
    few = few.select(F.col("g").alias("xg"), F.col("t").alias("xt"), F.col("n").alias("xn"), "at")
    any_ = few.join(t.select(F.col("g").alias("yg"), F.col("t").alias("yt"), F.col("n").alias("yn")), (F.col("xg") == F.col("yg")) & (F.col("at") == F.col("yn")) & (F.col("xt") != F.col("yt")))
    pairs = met.select("xg", "xt", "yt").unionByName(any_.select("xg", F.least("xt", "yt").alias("xt"), F.greatest("xt", "yt").alias("yt"))).distinct()
    longer = F.greatest(F.length("xt"), F.length("yt"), F.lit(1))
    pairs = pairs.withColumn("d", F.levenshtein("xt", "yt") / longer)
    return pairs.filter(F.col("d") <= most + 1e-9).select(F.col("xg").alias(group), F.col("xt").alias("a"), F.col("yt").alias("b"), "d")


#: Rows of a block with one title that :func:`resolve_entities` compares at a time, about.
HELD = 65_536


def resolve_entities(df: DataFrame, key: str, title: str, price: str, area: str, block: str, threshold: float = 0.85) -> DataFrame:
    """(a, b, score) of likely equal listings of a block: half the likeness of their titles (by edit distance) and a quarter of
    those of price and area reach the threshold. No such pair is lost. Rows in which one of the five columns is null never
    take part.

    What the threshold leaves for title, price and area together is a budget of differences. Different titles that keep within
    it are found first, among the titles of a block (:func:`similar_texts`), with their distance. Prices lie in logarithmic
    cells as wide as the budget, and a row is compared with the rows of the same or a similar title in its own cell and those
    beside it; so it is shuffled two or three times for each such title, whatever the number of rows. Where more than ``HELD``
    rows of a block share a title, they are dealt into parts that every row which looks for them goes to, and a cell that holds
    very many rows is split by Spark's skew join. Under a threshold of 0.75 prices restrict nothing any more, and at 0.5 or less
    titles do not either, as then all pairs of a block may reach it.
    """
    budget = 4 * (1 - threshold)
    width = max(1e-6, -math.log(1 - budget) * (1 + 1e-6)) if budget < 1 else None
    cell = lambda c: F.floor(F.log(F.greatest(F.abs(F.col(c)), F.lit(1.0))) / width) if width else F.lit(0).cast("long")
    t = df.select(F.col(key).alias("k"), F.lower(title).alias("t"), F.col(price).alias("p"), F.col(area).alias("s"), F.col(block).alias("g"))
    t = t.filter("k is not null and t is not null and p is not null and s is not null and g is not null")
    # Titles are counted where rows are read, so no row is shuffled for them; equal rows only make parts smaller.
    titles = t.groupBy("g", "t").agg(F.ceil(F.count(F.lit(1)) / HELD).alias("parts"))
    t = t.filter(cell("p").isNotNull()).repartition("g", "t").distinct()  # true of all; the join asks it of one side, which then had a shuffle of its own
    if budget < 2:
        other = similar_texts(titles, "g", "t", budget / 2)
    else:
        y = titles.select(F.col("g").alias("yg"), F.col("t").alias("b"))
        other = titles.join(y, (F.col("g") == F.col("yg")) & (F.col("t") < F.col("b"))).select("g", F.col("t").alias("a"), "b", (F.levenshtein("t", "b") / F.greatest(F.length("t"), F.length("b"), F.lit(1))).alias("d"))
    sought = titles.select(F.col("g").alias("_g"), F.col("t").alias("other"), "parts")
    aims = other.join(sought, (F.col("g") == F.col("_g")) & (F.col("b") == F.col("other"))).select("_g", "a", "other", "d", "parts")
    aims = aims.unionByName(sought.withColumns({"a": F.col("other"), "d": F.lit(0.0)}))
    # Of two cells one looks for the other, and so does one of two titles.
    left = t.join(aims, (F.col("g") == F.col("_g")) & (F.col("t") == F.col("a"))).withColumn("same", F.col("t") == F.col("other"))
    moves = F.when(F.col("same"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(-1), F.lit(0), F.lit(1))) if width else F.array(F.lit(0))
    left = left.withColumn("move", F.explode(moves)).withColumn("lpart", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    left = left.select(F.col("g").alias("lg"), "other", "lpart", (cell("p") + F.col("move")).alias("lpc"), F.col("k").alias("lk"), F.col("p").alias("lp"), F.col("s").alias("ls"), "d", (F.col("same") & (F.col("move") == 0)).alias("within"))
    dealt = t.join(sought, (F.col("g") == F.col("_g")) & (F.col("t") == F.col("other")))
    right = dealt.select("g", "t", F.pmod(F.xxhash64("k"), F.col("parts")).alias("part"), cell("p").alias("pc"), "k", "p", "s")
    on = [F.col(a) == F.col(b) for a, b in (("lg", "g"), ("other", "t"), ("lpart", "part"), ("lpc", "pc"))]
    pairs = left.join(right, [*on, (F.col("lk") != F.col("k")) & (~F.col("within") | (F.col("lk") < F.col("k")))])
    like = lambda a, b: 1 - F.abs(F.col(a) - F.col(b)) / F.greatest(F.abs(F.col(a)), F.abs(F.col(b)), F.lit(1.0))
    scored = pairs.select(F.least("lk", "k").alias("a"), F.greatest("lk", "k").alias("b"), (0.5 * (1 - F.col("d")) + 0.25 * like("lp", "p") + 0.25 * like("ls", "s")).alias("score"))
    return scored.filter(F.col("score") >= threshold)


def contains_any(text: Column, words: list[str]) -> Column:
    return contains_one(F.lower(text), [w.lower() for w in words])
