"""What grows with the input: plans, rows and bytes of steps that were found to grow too fast."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelwise.llm import partenum
from parcelwise.plans import listings


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_are_found_where_the_join_leaves_them(spark, sf):
    """Line items that are shuffled by order are not shuffled again, nor put together in buffers of structs."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(listings.latest(spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortAggregate" not in plan and "min_by" not in plan
    assert "hashpartitioning(property_id" not in plan and "hashpartitioning(_key" not in plan and "hashpartitioning(o_custkey" in plan


def test_shared_shingles_make_rows_by_range_and_not_by_set(spark):
    """Every set of a large component has shingles in every range; rows must not grow with sets times ranges."""
    docs = spark.range(800).select(F.col("id").alias("doc_id"), F.expr("concat_ws(' ', transform(sequence(1, 60), i -> concat('w', i + id)))").alias("text"))
    sizes = partenum.measured(docs, "doc_id", "text", 2)
    rows = partenum.shared_shingles(docs, sizes.select("set", "id", "key"), "doc_id", "text", 2, 4).collect()
    assert 0 < len(rows) <= 16 * 16
    sets = {x for r in rows for x in memoryview(bytes(r["sets"])).cast("q")}
    assert len(sets) == 800 and len({r["bucket"] for r in rows}) > 8


def test_classes_are_not_shuffled_into_one_task_each(spark):
    """Shares, weights and means of few classes and places meet the rows without a shuffle by class or place."""
    from parcelwise.operators import models

    rows = spark.range(200).select(F.col("id").cast("string").alias("property_id"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("label"))
    train, test = models.stratified_split(rows, "label", "property_id")
    for df in (train, test, models.with_class_weights(rows, "label")):
        plan = plan_of(df)
        assert "SortMergeJoin" not in plan and "hashpartitioning(label" not in plan
    assert train.count() + test.count() == 200


def test_snapshot_files_do_not_grow_with_a_city(spark, sf, monkeypatch):
    """A city of many orders has several files, and the result is that of one file for each city."""
    from parcelwise.sources import readers

    whole = sorted(listings.QUERIES["raw_snapshots"](spark, sf).collect())
    files = []
    monkeypatch.setattr(listings, "SPAN", 500, raising=False)
    monkeypatch.setattr(readers, "write_array_snapshot", lambda texts, *where, write=readers.write_array_snapshot: files.append(texts.count()) or write(texts, *where))
    assert sorted(listings.QUERIES["raw_snapshots"](spark, sf).collect()) == whole
    assert min(files) > 30


def test_landed_listings_are_worked_out_once(spark, sf, monkeypatch):
    """Both landings of the stream come from one table, not from the joins of all tables again."""
    from parcelwise.plans import streams

    plans = []
    monkeypatch.setattr(streams, "written", lambda df, write=streams.written: plans.append(plan_of(df)) or write(df))
    streams.incremental(spark, sf)
    assert len(plans) == 1 and "Join" in plans[0]


def test_rows_that_look_for_pairs_are_not_copied_to_every_cell(spark, sf, monkeypatch):
    """A row is shuffled at most three times for each title it looks for, titles are compared once and not for each pair of rows, all
    reads what was written, and a title of many rows is compared part by part with the same result."""
    from parcelwise.operators import cleaning

    pairs = listings.QUERIES["resolve_entities"](spark, sf)
    plan = plan_of(pairs)
    assert "explode([[" not in plan and "row_number() windowspecdefinition(orderkey" not in plan and "lineitem" not in plan
    assert not any("levenshtein" in line and "score" in line for line in plan.splitlines())
    whole = sorted(pairs.collect())
    monkeypatch.setattr(cleaning, "HELD", 3, raising=False)
    assert sorted(listings.QUERIES["resolve_entities"](spark, sf).collect()) == whole and len(whole) > 100


def test_latest_rows_carry_only_what_decides_the_columns_asked_for(spark, sf, tmp_path):
    """Ids with several rows of one time and prices and areas of all kinds: the columns asked for are those of the whole rows. Where only
    texts are asked for, prices and areas stay with the line items and no place is standardised."""
    import os

    for name in ("region", "nation", "customer", "part", "orders"):
        os.symlink(f"{sf}/{name}.parquet", tmp_path / f"{name}.parquet")
    items = spark.read.parquet(f"{sf}/lineitem.parquet").filter("l_orderkey < 600")
    again = lambda i, price, area: items.withColumns({"l_partkey": (F.col("l_partkey") + i) % 150 + 1, "l_extendedprice": F.expr(price), "l_quantity": F.expr(area)})
    items.union(again(7, "l_extendedprice + 1", "0.0")).union(again(11, "-1.0", "l_quantity")).union(again(20, "l_extendedprice", "l_quantity")).union(again(31, "double('NaN')", "cast(null as double)")).union(again(44, "0.0", "l_quantity")).write.parquet(str(tmp_path / "lineitem.parquet"))
    whole = listings.latest(spark, str(tmp_path)).cache()
    assert whole.count() > 1000
    for columns in (["title"], ["title", "source_category", "orderkey"], ["city", "price"], ["district"], ["title", "area_sqm"], ["posted_at", "price"], ["property_id", "bedrooms"]):
        found = listings.latest(spark, str(tmp_path), *columns).select(*columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.select(*columns).collect())), columns
    plan = plan_of(listings.QUERIES["classify_hybrid"](spark, sf))
    assert "_alias" not in plan and not [x for x in plan.splitlines() if ("Exchange" in x or "Sort" in x) and "price" in x]
    exchanged = listings.latest(spark, sf, "title", "source_category")._jdf.queryExecution().optimizedPlan().toString()
    assert [x for x in exchanged.splitlines() if "Filter" in x and "l_extendedprice" in x] and "_standard" not in exchanged


def test_only_valid_rows_are_those_without_a_reason(spark):
    from parcelwise.operators import cleaning

    texts = [None, "", "  ", "x", "0", "1", "-1", " 2 ", "1.5", "NaN", "Infinity", "-Infinity", "1e400", "99999999999"]
    rows = spark.createDataFrame([(a,) for a in texts], "a string")
    rows = rows.select(F.col("a").alias("price")).crossJoin(rows.select(F.col("a").alias("area_sqm"))).crossJoin(rows.select(F.col("a").alias("bedrooms")))
    rows = rows.withColumns({"property_id": F.lit("1"), "city": F.when(F.col("price") == "1", " ").otherwise("c"), "district": F.lit("d"), "posted_at": F.when(F.col("price") != "1.5", "t")})
    kept = sorted(map(str, cleaning.only_valid(rows).collect()))
    assert kept == sorted(map(str, cleaning.validate(rows)[0].select(*rows.columns).collect())) and len(kept) > 20


def test_merged_facts_write_what_they_need_and_once(spark, sf, monkeypatch):
    """Silver holds what the facts and dimensions come from, and facts that are new to the table are not written before they are written."""
    from parcelwise.sources import store

    columns = []
    for module in (listings, store):
        monkeypatch.setattr(module, "written", lambda df, write=store.written: columns.append(set(df.columns)) or write(df))
    listings.QUERIES["facts_merged"](spark, sf)
    assert columns[0] == {"city", "district", "property_type", "price_segment", "area_segment", "mapping_source", "property_id", "price"}
    assert len(columns) == 2 and "price_short" in columns[1]


def test_a_merge_that_keeps_columns_is_one_join(spark):
    """Null and repeated keys, columns that one side lacks: the rows are those of two joins."""
    from parcelwise.sources import store

    old = spark.createDataFrame([(1, "a", 10, 0.5), (2, "b", None, 1.5), (None, "c", 30, None), (3, None, 40, 2.5), (3, "e", 50, 3.5)], "id int, v string, made int, gone double")
    new = spark.createDataFrame([("x", 9, 2, 7), ("y", 8, None, 7), (None, 7, 3, 7), ("z", None, 4, 7), ("w", 5, 4, 8)], "v string, made long, id int, extra int")
    for null_safe in (False, True):
        same = lambda a, b, n=null_safe: a.eqNullSafe(b) if n else a == b
        was = old.select(F.col("id").alias("_id"), F.col("made").alias("_made"), F.lit(True).alias("_old"))
        took = new.join(was, same(new["id"], was["_id"]), "left").withColumn("made", F.when(F.col("_old"), F.col("_made")).otherwise(F.col("made"))).drop(*was.columns)
        want = old.join(took, same(old["id"], took["id"]), "left_anti").unionByName(took, allowMissingColumns=True)
        found = store.merge_upsert(old, new, ["id"], keep=["made"], null_safe=null_safe)
        assert found.columns == want.columns and [f.dataType for f in found.schema] == [f.dataType for f in want.schema]
        assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_repeated_keys_make_no_new_table(spark, tmp_path):
    import pytest

    from parcelwise.sources.store import TableStore

    tables = TableStore(spark, str(tmp_path), buckets=4)
    row = lambda *ids: spark.createDataFrame([(i, "v") for i in ids], "id int, v string")
    with pytest.raises(ValueError):
        tables.upsert("t", row(1, 2, 3, 4, 5, 5), ["id"])
    assert not tables.exists("t")
    tables.upsert("t", row(7, 8, None), ["id"])
    assert sorted(map(str, tables.read("t").collect())) == sorted(map(str, row(7, 8, None).collect()))
