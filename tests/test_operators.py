"""The scenarios that define the operators, on small rows."""

import json

import pytest
from pyspark.sql import functions as F

from parcelwise.functions import rules
from parcelwise.functions.columns import fingerprint
from parcelwise.operators import analytics, changes, cleaning, market, warehouse
from parcelwise.sources import readers, store
from parcelwise.streaming.incremental import process_batch

CITIES = {"Hồ Chí Minh": ["HCM", "SG", "Sài Gòn", "HCMC"]}
DISTRICTS = {"Quận 1": ["Q1"], "Quận 3": ["Q3"], "Quận Bình Thạnh": ["Bình Thạnh"]}
LISTING = "property_id string, city string, district string, price string, area_sqm string, bedrooms string, posted_at string"
AT = "2024-01-01T00:00:00Z"


def reasons(spark, *rows):
    return [r["dq_reason"] for r in cleaning.with_reason(spark.createDataFrame(rows, LISTING)).collect()]


def test_validation(spark):
    good = ("1", "HCMC", "Q1", "5e9", "50.0", "2", AT)
    assert reasons(
        spark, good, ("2", "HCMC", "", None, None, None, None), ("3", "HCMC", "Q1", "không_phải_số", "bảy_chục", "2", AT), ("4", "HCMC", "Q1", "-1000.0", "-5.0", "-1", AT),
        ("5", "  ", "Q1", "x", "1", "1", AT), ("6", "A", "Q1", "NaN", "1", "1", AT), ("7", "A", "Q1", "0", "1", "1", AT), ("8", "A", "Q1", "x", "-1", "1", AT),
    ) == [None, "missing_required_fields", "type_cast_failed", "numeric_constraint_failed", "missing_required_fields", "type_cast_failed", "numeric_constraint_failed", "type_cast_failed"]
    df = spark.createDataFrame([good, ("2", None, "", None, None, None, None)], LISTING)
    valid, invalid = cleaning.validate(df)
    assert (valid.count(), invalid.count(), valid.columns) == (1, 1, df.columns)
    assert cleaning.quality_metrics(cleaning.with_reason(df)).first().asDict() == {"total": 2, "valid": 1, "invalid": 1, "invalid_rate": 0.5}
    assert cleaning.quality_metrics(cleaning.with_reason(df.limit(0))).first()["invalid_rate"] == 0.0


def test_silver_and_gold(spark):
    now = F.lit("2024-01-11 00:00:00").cast("timestamp")
    df = spark.createDataFrame([("1", "t", "HCMC", "Q1", 5e9, 50.0, 2, AT), ("2", "t", "HCMC", "Q1", 1.5e10, 100.0, 2, AT), ("3", "t", "X", "Y", None, 0.0, 2, "2030-01-01T00:00:00Z")], "property_id string, title string, city string, district string, price double, area_sqm double, bedrooms int, posted_at string")
    silver = {r["property_id"]: r for r in market.to_silver(df, now).collect()}
    one = silver["1"]
    assert (one["price_billion_vnd"], one["price_segment"], one["area_segment"], one["price_per_sqm"], one["posted_date"], one["listing_age_days"]) == (5.0, "mid", "standard", 1e8, "2024-01-01", 10)
    assert (silver["3"]["price_segment"], silver["3"]["price_per_sqm"], silver["3"]["listing_age_days"]) == ("luxury", None, 0)
    gold = market.to_gold(market.to_silver(df, now), now).filter("city = 'HCMC'").first()
    assert (gold["listing_count"], gold["luxury_listing_ratio"], gold["avg_price"], gold["avg_area_sqm"], gold["max_price"], gold["min_price"]) == (2, 0.5, 1e10, 75.0, 1.5e10, 5e9)


def test_changes_over_three_days_and_within_a_batch(spark):
    schema, state = "property_id string, title string, price int, area_sqm int, seq int", spark.createDataFrame([], "property_id string, fingerprint string")
    fields, passed = ["property_id", "title", "price", "area_sqm"], []
    for rows in ([("1", "a", 5000, 50, 1), ("2", "b", 3000, 80, 1)],) * 2 + ([("1", "a", 4500, 50, 1), ("2", "b", 3000, 80, 1), ("3", "c", 1000, 120, 1)],):
        marked = changes.detect_changes(spark.createDataFrame(rows, schema), state, "property_id", fields, "seq")
        passed.append(sorted(r["property_id"] for r in changes.changed(marked).collect()))
        state = changes.next_state(marked, state, "property_id")
    assert passed == [["1", "2"], [], ["1", "3"]]
    empty = spark.createDataFrame([], "property_id string, fingerprint string")
    batch = spark.createDataFrame([("1", "a", 1, 1, 1), ("1", "b", 1, 1, 2), ("1", "a", 1, 1, 3), ("2", "a", 1, 1, 1), ("2", "a", 1, 1, 2), (" ", "a", 1, 1, 1)], schema)
    marked = changes.detect_changes(batch, empty, "property_id", fields, "seq")
    assert sorted((r["property_id"], r["seq"], r["status"]) for r in marked.collect()) == [("1", 1, "NEW"), ("1", 2, "UPDATED"), ("1", 3, "UPDATED"), ("2", 1, "NEW"), ("2", 2, "UNCHANGED")]


def test_tied_sequences_leave_the_state_of_the_last_compared_row(spark):
    schema, empty = "property_id string, title string, price int, area_sqm int, seq int", spark.createDataFrame([], "property_id string, fingerprint string")
    fields = ["property_id", "title", "price", "area_sqm"]
    rows = [(str(i), t, p, 1, 1) for i in range(6) for t in "ab" for p in (1, 2)]
    state = changes.next_state(changes.detect_changes(spark.createDataFrame(rows, schema), empty, "property_id", fields, "seq"), empty, "property_id")
    assert state.count() == 6
    last = spark.createDataFrame([(str(i), "b", 2, 1, 2) for i in range(6)], schema)
    assert {r["status"] for r in changes.detect_changes(last, state, "property_id", fields, "seq").collect()} == {"UNCHANGED"}


def test_fingerprint_keeps_fields_apart(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, ""), ("", None)], "x string, y string")
    assert len({r["h"] for r in rows.select(fingerprint([F.col("x"), F.col("y")], "sha256").alias("h")).collect()}) == 4


def test_standardise_classify_and_quarantine(spark):
    rows = spark.createDataFrame(
        [("1", "Ban can ho gia re", "Mua ban", "HCM", "Q1"), ("2", "Biet thu cao cap", "Dat nong nghiep", "Sài Gòn", "Bình Thạnh"), ("3", "Kiot doi dien", "Kiot Thuong Mai", " SG ", "Q3"), ("4", "Bán nhà đất mặt bằng", "Khác", "HCM", "Xã Lạ")],
        "property_id string, title string, source_category string, city string, district string",
    )
    clean = lambda extra: lambda d: cleaning.standardize(d, {"city": CITIES, "district": DISTRICTS | extra})
    mapped, left = cleaning.reprocess_quarantine(rows, None, clean({}))
    assert {(r["property_id"], r["city"], r["district"]) for r in mapped.collect()} == {("1", "Hồ Chí Minh", "Quận 1"), ("2", "Hồ Chí Minh", "Quận Bình Thạnh"), ("3", "Hồ Chí Minh", "Quận 3")}
    assert [(r["property_id"], r["district"]) for r in left.collect()] == [("4", "Xã Lạ")]
    released, none = cleaning.reprocess_quarantine(rows.limit(0), left, clean({"Huyện Mới": ["Xã Lạ"]}))
    assert (released.count(), none.count()) == (1, 0)
    kinds = {r["property_id"]: (r["property_type"], r["mapping_source"]) for r in cleaning.classify_by_keywords(rows).collect()}
    assert kinds["4"] == ("Văn phòng/Mặt bằng", rules.FROM_TITLE)
    assert kinds["1"] == ("Mua ban", rules.FROM_MODEL_LATER)


def test_routing_by_confidence(spark):
    rows = spark.createDataFrame([(rules.UNKNOWN_TYPE, "x", "A", 0.87), (rules.UNKNOWN_TYPE, "x", "A", 0.5), (rules.UNKNOWN_TYPE, "x", None, None), ("B", "y", "A", 0.9)], "property_type string, mapping_source string, l string, c double")
    assert [(r[0], r[1]) for r in cleaning.route_by_confidence(rows, "l", "c").select("property_type", "mapping_source").collect()] == [("A", "ML Model (87%)"), (rules.UNKNOWN_TYPE, rules.FROM_MODEL_NEVER), (rules.UNKNOWN_TYPE, rules.FROM_MODEL_NEVER), ("B", "y")]


def test_weak_labels(spark):
    rows = spark.createDataFrame([("1", "Bán nhà mặt tiền Lê Văn Sỹ", "Nhà ở"), ("2", "Phòng trọ mới xây", "Phòng trọ"), ("3", "Sang quán cafe", "Văn phòng, Mặt bằng kinh doanh"), ("4", "abc", "def")], "id string, title string, source_category string")
    rows = market.weak_label(rows, rules.LISTING_TIERS, "l", "lc", ("UNKNOWN", 0.3))
    rows = market.weak_label(rows, rules.PROPERTY_TIERS, "p", "pc", ("UNMAPPED", 0.0))
    assert [(r["l"], r["lc"], r["p"], r["pc"]) for r in rows.orderBy("id").collect()] == [("BAN", 0.8, "Nhà phố/Nhà riêng", 0.85), ("CHO_THUE", 0.95, "Phòng trọ/Nhà trọ", 0.9), ("SANG_NHUONG", 0.85, "Sang nhượng/Mặt bằng", 0.9), ("UNKNOWN", 0.3, "UNMAPPED", 0.0)]


def test_normalise_tells_missing_from_null(spark, tmp_path):
    ads = [
        {"list_id": 1, "subject": " Nhà ", "region_name": "HN", "area_name": "Q1", "price": 5, "list_time": 1704067200000, "size": "50", "rooms": "2", "category_name": "Nhà ở"},
        {"list_id": 2, "price": 1}, {"list_id": 3, "subject": None, "price": 1}, {"list_id": 4, "price": "x"}, {"subject": "no id"}, {"list_id": 5, "rooms": "nhiều", "list_time": 1704067200}, "no ad",
    ]
    (tmp_path / "a.json").write_text(json.dumps({"ads": ads}, ensure_ascii=False), encoding="utf-8")
    rows = {r["property_id"]: r for r in readers.normalize(readers.raw_records(spark, str(tmp_path))).collect()}
    assert set(rows) == {"1", "2", "5"}
    assert (rows["1"]["title"], rows["1"]["price"], rows["1"]["bedrooms"], rows["1"]["posted_at"]) == ("Nhà", 5.0, 2, AT)
    assert (rows["2"]["city"], rows["2"]["source_category"], rows["2"]["posted_at"]) == ("Unknown", "Khác", "1970-01-01T00:00:00Z")
    assert (rows["5"]["bedrooms"], rows["5"]["posted_at"]) == (0, AT)


def test_store_generations_and_upserts(spark, tmp_path):
    tables = store.TableStore(spark, str(tmp_path))
    assert not tables.exists("t") and tables.read_or_none("t") is None
    tables.upsert("t", spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, v string, made int"), ["id"])
    tables.upsert("t", spark.createDataFrame([(2, "c", 99), (3, "d", 30)], "id int, v string, made int"), ["id"], keep=["made"])
    assert sorted(map(tuple, tables.read("t").collect())) == [(1, "a", 10), (2, "c", 20), (3, "d", 30)]
    assert tables.read("t", 0).count() == 2
    tables.overwrite("t", tables.read("t").filter("id > 1"))
    assert tables.read("t").count() == 2
    with pytest.raises(ValueError):
        tables.upsert("t", spark.createDataFrame([(1, "a", 1), (1, "b", 1)], "id int, v string, made int"), ["id"])
    day = lambda n, d: spark.createDataFrame([("x", n, d), ("y", n, d)], "place string, n int, day string")
    tables.upsert_partitions("g", day(1, "2024-01-01"), ["place"], "day")
    tables.upsert_partitions("g", day(2, "2024-01-02"), ["place"], "day")
    tables.upsert_partitions("g", day(3, "2024-01-02").filter("place = 'x'"), ["place"], "day")
    assert sorted((r["place"], r["n"], str(r["day"])) for r in tables.read("g").collect()) == [("x", 1, "2024-01-01"), ("x", 3, "2024-01-02"), ("y", 1, "2024-01-01"), ("y", 2, "2024-01-02")]
    null = spark.createDataFrame([(None, 1)], "k string, v int")
    assert store.merge_upsert(null, null, ["k"]).count() == 2 and store.merge_upsert(null, null, ["k"], null_safe=True).count() == 1


def test_batch_is_repeatable_and_survives_a_crash(spark, tmp_path):
    tables = store.TableStore(spark, str(tmp_path))
    rows = [("1", "t", "HCM", "Q1", "5e9", "50", "2", AT), ("2", "t", "HCM", "Lạ", "5e9", "50", "2", AT), ("3", "t", "HCM", "Q1", "x", "50", "2", AT)]
    batch = spark.createDataFrame(rows, "property_id string, title string, city string, district string, price string, area_sqm string, bedrooms string, posted_at string")
    clean = lambda d: cleaning.standardize(d, {"city": CITIES, "district": DISTRICTS})
    now = F.lit("2024-01-11 00:00:00").cast("timestamp")
    real, state = tables.upsert, {}

    def fails(name, *args, **how):
        if name == "cdc_state" and not state:
            state["failed"] = True
            raise RuntimeError("crash before the state is saved")
        return real(name, *args, **how)

    tables.upsert = fails
    with pytest.raises(RuntimeError):
        process_batch(batch, tables, clean, now, "2024-01-11")
    for _ in range(2):
        process_batch(batch, tables, clean, now, "2024-01-11")
    assert [r["property_id"] for r in tables.read("silver").collect()] == ["1"]
    assert tables.read("gold").first()["listing_count"] == 1
    assert tables.read("cdc_state").count() == 3
    assert tables.read("bronze").count() == 3 and tables.read("quarantine").count() == 1
    state["failed"] = False  # the next batch crashes before the state, and is repeated
    more = spark.createDataFrame([("4", "t", "HCM", "Q1", "7e9", "50", "2", AT), ("5", "t", "HCM", "Lạ", "5e9", "50", "2", AT)], batch.schema)

    def once(name, *args, **how):
        if name == "cdc_state" and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("crash")
        return real(name, *args, **how)

    tables.upsert = once
    with pytest.raises(RuntimeError):
        process_batch(more, tables, clean, now, "2024-01-11", "1")
    process_batch(more, tables, clean, now, "2024-01-11", "1")
    assert (tables.read("bronze").count(), tables.read("quarantine").count(), tables.read("silver").count(), tables.read("quality").count()) == (5, 2, 2, 2)
    assert tables.read("gold").first()["listing_count"] == 2 and tables.read("gold", 0).first()["listing_count"] == 1


def test_open_bands_by_cells_and_literal_tables(spark):
    bands = store.literal_table(spark, [("low", 0.0, 10.0), ("mid", 10.0, 30.0), ("high", 30.0, None)], "name string, a double, b double")
    values = spark.createDataFrame([(-1.0,), (0.0,), (9.9,), (10.0,), (29.0,), (30.0,), (1e6,), (None,)], "v double")
    for grid in (False, True):
        found = warehouse.range_join(values, bands, "v", "a", "b", ["name"], grid=grid)
        assert [r["name"] for r in found.collect()] == [None, "low", "low", "mid", "mid", "high", "high", None]
    assert store.sized(values, 3) is values and store.sized(values, 8).count() == 8


def test_dimensions_keep_their_keys(spark):
    first = warehouse.dim_location(spark.createDataFrame([("B", "x"), ("A", "y")], "city string, district string"), {"A": "North"})
    again = warehouse.dim_location(spark.createDataFrame([("0", "x"), ("A", "y"), ("B", "x")], "city string, district string"), {"A": "North"}, old=first)
    keys = {r["city"]: (r["location_key"], r["region_code"]) for r in again.collect()}
    assert keys == {"A": (1, "North"), "B": (2, "OTHER"), "0": (3, "OTHER")}
    assert warehouse.dim_time(spark).count() == 1827


def test_range_joins_agree_and_leave_no_gap(spark):
    bands = warehouse.half_open(warehouse.dim_price_segment(spark).drop("valid_from", "valid_to"), "price_floor", "price_ceiling")
    values = spark.createDataFrame([(3999999999.995,), (4e9,), (1e12,), (-1.0,), (None,)], "v double")
    assert [r["segment_name"] for r in warehouse.range_join(values, bands, "v", "price_floor", "price_ceiling", ["segment_name"]).collect()] == ["affordable", "mid", "luxury", None, None]


def test_rollup_levels(spark):
    rows = spark.createDataFrame([("r", "c", "d"), ("r", "c", "e")], "a string, b string, c string")
    found = {(r["a"], r["b"], r["c"], r["level"]): r["n"] for r in analytics.drilldown_rollup(rows, ["a", "b", "c"]).collect()}
    assert found == {(None, None, None, 3): 2, ("r", None, None, 2): 2, ("r", "c", None, 1): 2, ("r", "c", "d", 0): 1, ("r", "c", "e", 0): 1}


def test_resolve_entities_loses_no_pair_of_a_block(spark):
    prices = [-5.0, 0.0, 0.4, 0.9, 1.0, 1.5, 1e9, 1.7e9, 2.4e9, 2.6e9, 4e9, 6.2e9, 9.9e9, 12e9, 14.2e9, 25e9, 3e10]
    rows = [(f"{i:02}", "big house" if i % 3 else "big houses", p, 50.0 + i % 2, "x") for i, p in enumerate(prices)]
    frame = spark.createDataFrame(rows, "id string, title string, price double, area double, place string")
    like = lambda a, b: 1 - abs(a - b) / max(abs(a), abs(b), 1.0)
    for threshold in (0.95, 0.85, 0.7, 1.0):
        want = set()
        for i, (a, s, p, m, _) in enumerate(rows):
            for b, t, q, n, _ in rows[i + 1 :]:
                if 0.5 * (1 - (s != t) / max(len(s), len(t))) + 0.25 * like(p, q) + 0.25 * like(m, n) >= threshold:
                    want.add((a, b))
        assert {(r["a"], r["b"]) for r in cleaning.resolve_entities(frame, "id", "title", "price", "area", "place", threshold).collect()} == want


def test_clean_records_clamps_rounds_and_keeps_the_latest(spark):
    rows = spark.createDataFrame(
        [("1", "Bán nhà phố", "HCM", "Q1", "5.005", "10.126", "-3", AT), ("1", "Bán đất", " sg ", "Q1", "7", "1", None, "2024-02-01T00:00:00Z"), ("2", "abc", "HCM", "Lạ", "x", "1", "4", AT)],
        "property_id string, title string, city string, district string, price string, area_sqm string, bedrooms string, posted_at string",
    )
    found = {r["property_id"]: r for r in cleaning.clean_records(rows, {"city": CITIES, "district": DISTRICTS}).collect()}
    assert (found["1"]["city"], found["1"]["price"], found["1"]["bedrooms"], found["1"]["mapping_status"], found["1"]["property_type"]) == ("Hồ Chí Minh", 7.0, 0, "MAPPED", "Đất nền/Đất dự án")
    assert (found["2"]["price"], found["2"]["bedrooms"], found["2"]["mapping_status"]) == (None, 4, "UNMAPPED")
    one = cleaning.clean_records(rows.filter("posted_at < '2024-02'"), {"city": CITIES, "district": DISTRICTS}).filter("property_id = '1'").first()
    assert (one["price"], one["area_sqm"], one["bedrooms"]) == (5.01, 10.13, 0)
    table = spark.createDataFrame([("HCM", "A", "city", True), ("hcm", "B", "city", False), ("Q1", "C", "district", True)], "alias string, standard string, kind string, is_current boolean")
    assert [tuple(r) for r in readers.rules_table(table, "city").collect()] == [("hcm", "A")]


def test_training_files_of_several_formats_snapshots_and_exports(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"subject": "x", "price": 1}, {"subject": "y"}]), encoding="utf-8")
    (tmp_path / "b.csv").write_text("subject,price\nz,3\n", encoding="utf-8")
    spark.createDataFrame([("w", "4")], "subject string, price string").write.parquet(str(tmp_path / "c.parquet"))
    found = readers.read_training(spark, [str(tmp_path / n) for n in ("a.json", "b.csv", "c.parquet")], {"subject": "title", "price": "cost"})
    assert sorted((r["title"], r["cost"]) for r in found.select("title", "cost").collect()) == sorted([("x", "1"), ("y", None), ("z", "3"), ("w", "4")], key=str)
    store.export_csv(found, str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 4
    path = store.write_snapshot(found, str(tmp_path / "raw"), "20240101")
    assert spark.read.json(path).count() == 4 and readers.snapshots(spark, path).filter("length >= 0").count() >= 1


def test_facts_keep_their_creation_and_tables_answer_sql(spark, tmp_path):
    tables = store.TableStore(spark, str(tmp_path))
    day = lambda n, d: spark.createDataFrame([(1, n, d)], "listing_key long, price int, created_at string")
    tables.upsert_fact("fact", day(5, "d1"), "listing_key")
    tables.upsert_fact("fact", day(7, "d2"), "listing_key")
    tables.register("fact")
    assert [tuple(r) for r in spark.sql("select * from fact").collect()] == [(1, 7, "d1")]


def test_models_are_compared_saved_loaded_and_used(spark, tmp_path):
    from parcelwise.operators import models

    rows = [(str(i), "bán nhà đẹp" if i % 2 else "cho thuê phòng", "Nhà" if i % 3 else "Phòng", f"C{i % 3}", f"D{i % 4}", float(i % 7 + 1), 50.0, i % 4, "BAN" if i % 2 else "THUE") for i in range(120)]
    frame = spark.createDataFrame(rows, "property_id string, title string, source_category string, city string, district string, price double, area_sqm double, bedrooms int, label string")
    frame = market.build_features(frame)
    model, scores, means = models.train_and_compare(frame, "label", trees=5, folds=2, rounds=2, version="v7")
    table = {r["model"]: r for r in scores.collect()}
    assert set(table) == {"logistic", "forest", "boosted", "soft_vote"} and max(r["accuracy"] for r in table.values()) > 0.9
    assert sum(r["cv_accuracy"] is not None for r in table.values()) == 1 and all((r["cv_accuracy"] or 1) > 0.9 and (r["cv_deviation"] or 0) < 0.2 for r in table.values())
    every = models.fit_models(frame, "label", trees=5, rounds=2)
    for n, one in enumerate((model, every)):
        models.save_model(one, str(tmp_path / str(n)))
        back = models.load_model(str(tmp_path / str(n)))
        assert (back.labels, back.version, back.columns, set(back.members)) == (one.labels, one.version, [*models.NUMBERS, *models.FLAGS], set(one.members))
        assert {r[0]: r[1] for r in back.means.collect()} == {r[0]: r[1] for r in one.means.collect()}
        out = models.predict(back, frame)
        assert out.filter("label_ml = label").count() > 110 and out.filter("confidence_ml between 0.3 and 1").count() == 120
        routed = cleaning.route_by_confidence(out.withColumns({"property_type": F.lit(rules.UNKNOWN_TYPE), "mapping_source": F.lit("x")}), "label_ml", "confidence_ml")
        assert routed.filter("property_type = label").count() > 90
        one_row = models.predict(back, frame.filter("property_id = '7'")).first()  # means are the model's, not those of the rows scored
        assert one_row["confidence_ml"] == pytest.approx(out.filter("property_id = '7'").first()["confidence_ml"])
    assert len(every.members["boosted"]) == 2 and model.version == "v7"


def test_vocabulary_equals_a_brute_force_count(spark):
    """Words and pairs of words together, the most frequent of those in two titles at least, as log-scaled counts with IDF."""
    import math
    from collections import Counter

    from pyspark.ml import Pipeline

    from parcelwise.operators import models

    titles = ["bán nhà bán nhà đẹp", "bán nhà phố", "cho thuê nhà", "cho thuê phòng", "phòng phòng phòng", "một mình", ""]
    frame = spark.createDataFrame([(t, "x") for t in titles], "title string, source_category string")
    fitted = Pipeline(stages=models.term_stages(terms=6)).fit(frame)
    terms = [[w for w in t.split()] + [" ".join(p) for p in zip(t.split(), t.split()[1:])] for t in titles]
    held, used = Counter(x for own in terms for x in set(own)), Counter(x for own in terms for x in own)
    counts = Counter({x: n for x, n in used.items() if held[x] >= 2})
    chosen = models.vocabulary(fitted)
    assert len(chosen) == 6 and set(x for x, n in counts.items() if n > counts[chosen[-1]]) <= set(chosen) and all(counts[x] >= min(counts[y] for y in chosen) for x in chosen)
    for t, own, r in zip(titles, terms, fitted.transform(frame).collect(), strict=True):
        assert r["title"] == t
        for k, x in enumerate(chosen):
            n = own.count(x)
            assert r["_terms_idf"][k] == pytest.approx((1 + math.log(n) if n else 0) * math.log((len(titles) + 1) / (held[x] + 1)))


def test_exact_quantiles_equal_the_sorted_values(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    rows = [(g, float(v)) for g, n in (("a", 900), ("b", 1), ("c", 2), (None, 50)) for v in np.concatenate([rng.normal(0, 1e9, n), np.repeat(7.25, n // 3)])]
    rows += [("a", None), ("a", float("nan")), ("a", 0.0), ("a", -0.0), ("empty", None), ("a", 5e-324), ("a", 1e308)]
    frame, shares = spark.createDataFrame(rows, "g string, v double"), [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    found = {r["g"]: (r["n"], r["q"]) for r in market.exact_quantiles(frame, "v", shares, "g").collect()}
    assert set(found) == {"a", "b", "c", None}
    for g, (n, q) in found.items():
        own = np.array([v for h, v in rows if h == g and v is not None and v == v])
        assert n == len(own) and np.allclose(q, np.quantile(own, shares), rtol=1e-12)
    assert market.exact_quantiles(frame.filter("false"), "v", shares, "g").count() == 0
    assert market.exact_quantiles(frame, "v", [0.5]).first()["n"] == len([1 for _, v in rows if v is not None and v == v])


def test_grids_equal_plain_range_joins(spark):
    """Disjoint, overlapping, very wide, empty and open bands, with periods; NaN, null and boundary values; no nested loop."""
    import random

    rng = random.Random(4)
    ends = [(float(a), float(a + rng.choice([0, 1, 1, 2, 30, 500]))) for a in rng.choices(range(200), k=300)] + [(0.0, 1000.0), (50.0, None), (199.0, None), (None, 5.0)]
    days = [f"2024-0{rng.randint(1, 6)}-1{rng.randint(0, 9)}" for _ in ends]
    bands = spark.createDataFrame([(a, b, d, None if k % 9 == 0 else f"2024-0{rng.randint(5, 9)}-01", k) for k, ((a, b), d) in enumerate(zip(ends, days, strict=True))], "a double, b double, f string, t string, band int")
    bands = bands.select("a", "b", F.to_date("f").alias("valid_from"), F.to_date("t").alias("valid_to"), "band")
    facts = [(k, v, f"2024-0{k % 9 + 1}-15" if k % 11 else None) for k, v in enumerate([-1.0, 0.0, 1.0, 199.0, 1e9, float("nan"), None, float("inf"), *[rng.randint(0, 420) / 2 for _ in range(120)]])]
    facts = spark.createDataFrame(facts, "id int, v double, day string").withColumn("day", F.to_date("day"))
    for join in (lambda g: warehouse.range_join(facts, bands, "v", "a", "b", ["band"], grid=g), lambda g: warehouse.point_in_time_join(facts, bands, "v", "day", "a", "b", ["band"], grid=g)):
        plain, cells = (sorted(((r["id"], r["band"]) for r in join(g).collect()), key=str) for g in (False, True))
        assert plain == cells and len(plain) > 130
        assert "NestedLoop" not in join(True)._jdf.queryExecution().executedPlan().toString()


def test_one_alias_maps_apart_in_two_cities(spark):
    rows = spark.createDataFrame([("1", "HCM", "Trung tâm"), ("2", "hn", "TRUNG TÂM "), ("3", "HP", "trung tâm"), ("4", "HN", "Q1"), ("5", "xx", "Q1"), ("6", "HN", "lạ")], "id string, city string, district string")
    cities = {"Hồ Chí Minh": ["HCM"], "Hà Nội": ["HN"], "Hải Phòng": ["HP"]}
    districts = cleaning.scoped_table(rows, {("Hồ Chí Minh", "Quận 1"): ["Trung tâm", "Q1"], ("Hà Nội", "Hoàn Kiếm"): ["Trung tâm"], (None, "Trung Tâm"): [], (None, "Quận 1"): ["Q1"]})
    found = {r["id"]: (r["district"], r["mapping_status"]) for r in cleaning.standardize(rows, {"city": cities, "district": districts}, scopes={"district": "city"}).collect()}
    assert found == {"1": ("Quận 1", "MAPPED"), "2": ("Hoàn Kiếm", "MAPPED"), "3": ("Trung Tâm", "MAPPED"), "4": ("Quận 1", "MAPPED"), "5": ("Quận 1", "UNMAPPED"), "6": ("lạ", "UNMAPPED")}


def test_cells_give_gold_within_the_rank_error(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [(str(k), f"c{k % 2}", "d", float(v), 50.0 + k % 7, f"2024-01-{k % 28 + 1:02}T00:00:00Z") for k, v in enumerate(rng.lognormal(22, 1, 6000))]
    rows += [("n", "c1", "e", None, None, "2024-01-01T00:00:00Z")]
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    silver = market.to_silver(spark.createDataFrame(rows, "property_id string, city string, district string, price double, area_sqm double, posted_at string"), now)
    exact = {(r["city"], r["district"]): r for r in market.to_gold(silver, now, accuracy=1_000_000).collect()}
    cells = market.gold_cells(silver)
    for r in market.gold_of_cells(cells, now).collect():
        for c in ("listing_count", "avg_price", "avg_area_sqm", "max_price", "min_price", "avg_listing_age_days", "luxury_listing_ratio", "snapshot_at"):
            assert r[c] == pytest.approx(exact[r["city"], r["district"]][c]) if isinstance(r[c], float) else r[c] == exact[r["city"], r["district"]][c], c
        own = sorted(x[3] for x in rows if (x[1], x[2]) == (r["city"], r["district"]) and x[3] is not None)
        for c, p in (("median_price", 0.5), ("p90_price", 0.9)):
            assert (r[c] is None) == (not own) and (not own or abs(np.searchsorted(own, r[c]) / len(own) - p) < 0.01)
    up = market.gold_of_cells(cells, now, keys=("city",)).filter("city = 'c0'").first()
    assert up["listing_count"] == 3000
