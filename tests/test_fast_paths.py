"""Text that needs no pattern goes around it; what comes out is what the pattern gives."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelwise.functions.columns import fingerprint, last_match, searched, squeezed, timestamp_of
from parcelwise.operators import cleaning, market

ODD = [None, "", " ", "  ", "a", " a ", "a b", "a  b", "\ta", "a\t", " \t a\r\n b ", "a\x0bb\fc", "\u00a0a\u00a0 b", "a\\b", "a|b", "\\|", "Z", "Ring|x", "a.b"]
TIMES = [None, "", "Z", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02T03:04:05.6Z", "2024-01-02T03:04:05", "2024-01-02Z", "2024-1-2T3:4:5.12345Z", "2024-01-02T03:04:05Z\n", "2024-13-02T03:04:05Z", "xxxxxxxxxxxxxxxxxxxZ", "2024-01-02T03:04+01Z", "+2024-01-02T3:04:05Z", "2024-01-02T03:04:0UTZ", "2024-01-02T03:04   Z"]


def test_squeezed_escaped_and_searched_text_is_what_the_patterns_give(spark):
    rows = spark.createDataFrame([(x,) for x in ODD], "x string")
    x = F.col("x")
    old = F.md5(F.concat_ws("|", F.coalesce(F.regexp_replace(x, r"([\\|])", r"\\$1"), F.lit("\\N"))).cast("binary"))
    found = rows.select(
        squeezed(x).eqNullSafe(F.trim(F.regexp_replace(x, r"\s+", " "))).alias("squeezed"), fingerprint([x]).eqNullSafe(old).alias("fingerprint"),
        *[searched(x, p).eqNullSafe(x.rlike(p)).alias(f"p{i}") for i, p in enumerate(("a|Ring", r"\ba\b", "a.b", "|", "a b"))],
        last_match(x, {"one": ["a.b"], "two": ["RING"]}, F.lit("none")).eqNullSafe(F.when(F.lower(x).contains("ring"), "two").when(F.lower(x).contains("a.b"), "one").otherwise("none")).alias("match"),
    )
    assert all(all(r) for r in found.collect())


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh"])
def test_times_are_read_as_they_were_with_an_offset(spark, zone):
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(x,) for x in TIMES], "x string")
        found = rows.select("x", F.unix_micros(timestamp_of(F.col("x"))).alias("new"), F.unix_micros(F.try_to_timestamp(F.regexp_replace("x", "Z$", "+00:00"))).alias("old")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)
    assert [(r["x"], r["new"]) for r in found] == [(r["x"], r["old"]) for r in found]
    assert sum(r["new"] is not None for r in found) > 5


def test_plain_words_are_no_patterns_in_the_plan_and_numbers_are_cast_once(spark, sf):
    from parcelwise.plans import listings

    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    rows = listings.tagged(spark, sf)
    assert plan(rows).count("try_cast(price") == 1
    words = market.weak_label(rows, [("title", "widget|cold", "A", 0.8), ("source_category", "rod", "B", 0.8)], "l", "c", ("U", 0.3))
    assert "RLIKE" not in plan(words) and "RLIKE" not in plan(cleaning.classify_by_keywords(rows, listings.KEYWORDS))


def test_ads_are_parsed_twice_and_not_once_for_each_use(spark):
    from parcelwise.sources import readers

    whole = '"list_id":"%s","price":%s,"size":"2","list_time":1700000000'
    texts = [None, "", "x", "[]", "{", "{}", "{" + whole % (1, '"3.5"') + "}", "{" + whole % (2, "1.50") + ',"rooms":null}', "{" + whole % (3, '"ask"') + "}", "{" + whole % (4, "7") + ',"subject":{"a":[1, 2]},"rooms":3}', "{" + whole % (5, "7"), '{"price":1}', "{" + whole % (6, "1") + ',"list_id":"7"}']
    rows = spark.createDataFrame([(t,) for t in texts], "record string")
    found, counted = readers.normalize_counted(rows)
    kept = sorted(tuple(r) for r in found.collect())
    assert [r[:2] + (r[4],) for r in kept] == [("1", "", 3.5), ("4", '{"a":[1,2]}', 7.0), ("7", "", 1.0)]
    assert kept == sorted(tuple(r) for r in readers.normalize(rows).collect())
    assert counted.get == {"records": 13, "no_ad": 6, "without_id": 2, "null_field": 1, "bad_number": 1, "kept": 3}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("jsonObjectKeys(") + plan.count("json_object_keys(") == 1 and "get_json_object" not in plan


def test_both_sides_of_the_quarantine_come_from_one_reading(spark, sf):
    """Mapped and unmapped rows are read from what was cleaned; nothing is joined and sorted for each of them again."""
    from parcelwise.plans import listings

    plan = listings.QUERIES["quarantine_reprocess"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "lineitem" not in plan


@pytest.mark.parametrize("name", ["gold_touched", "layer_inventory", "outliers_iqr"])
def test_latest_listings_are_worked_out_once(spark, sf, name):
    """The latest rows are ranked by the write only; the rest of the query reads them."""
    from parcelwise.plans import listings

    plan = listings.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "row_number()" not in plan


def test_change_detection_writes_only_what_it_reads(spark, sf, monkeypatch):
    from parcelwise.plans import listings

    columns = []
    monkeypatch.setattr(listings, "written", lambda df, write=listings.written: columns.append(df.columns) or write(df))
    listings.QUERIES["cdc_changes"](spark, sf)
    assert columns == [["property_id", "title", "city", "district", "price", "posted_at", "orderkey"]]


def test_the_quantile_reads_written_prices(spark, sf, monkeypatch):
    from parcelwise.plans import listings

    columns = []
    monkeypatch.setattr(listings, "written", lambda df, write=listings.written: columns.append(df.columns) or write(df))
    listings.QUERIES["dim_price_segment_scd2"](spark, sf)
    assert columns == [["price"]]


def test_keys_of_an_ad_are_parsed_only_where_a_field_is_missing(spark):
    """Whole ads are parsed once; where a field is null, the keys say whether it was given as null or not at all."""
    import re

    from parcelwise.sources import readers

    whole = '"list_id":"9","subject":"s","region_name":"r","area_name":"a","price":"1","list_time":"1","size":"2","rooms":"3","category_name":"c"'
    texts = ["{" + whole + "}", "{" + whole + "} x", "{" + whole.replace('"subject":"s",', "") + "}", "{" + whole.replace('"s"', "null") + "}", "{" + whole, "[{" + whole + "}]", None]
    found, counted = readers.normalize_counted(spark.createDataFrame([(t,) for t in texts], "record string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"CASE WHEN [^\n]*isnull\([^\n]* THEN [^\n]*(jsonObjectKeys|json_object_keys)\(", plan)
    assert sorted(r["title"] for r in found.collect()) == ["", "s", "s"]
    assert counted.get == {"records": 7, "no_ad": 3, "without_id": 0, "null_field": 1, "bad_number": 0, "kept": 3}


def test_a_committed_batch_is_not_read_again(spark, sf, monkeypatch):
    from parcelwise.plans import streams

    read = []
    monkeypatch.setattr(streams.readers, "normalize_counted", lambda *a, read_=streams.readers.normalize_counted: read.append(a) or read_(*a))
    streams.layers(spark, sf)
    assert len(read) == 2
