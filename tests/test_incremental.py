"""Batches that are repeated, late or stale, tables of touched parts, counted drops, and the index of similar texts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import cleaning
from parcelwise.sources import readers, store
from parcelwise.streaming.incremental import process_batch

AT = "2024-01-01T00:00:00Z"
SCHEMA = "property_id string, title string, city string, district string, price string, area_sqm string, bedrooms string, posted_at string"
OLD, NEW = {"Quận 1": ["Q1"]}, {"Quận 1": ["Q1"], "Huyện Mới": ["Lạ"]}


def listing(i, district="Q1", price="100", at=AT):
    return (i, "t", "HCM", district, price, "50", "2", at)


@pytest.fixture
def run(spark, tmp_path):
    tables = store.TableStore(spark, str(tmp_path / "tables"), buckets=4)
    now = F.lit("2024-01-11 00:00:00").cast("timestamp")

    def one(batch_id, *rows, districts=OLD):
        clean = lambda d: cleaning.standardize(d, {"city": {"Hồ Chí Minh": ["HCM"]}, "district": districts})
        process_batch(spark.createDataFrame(list(rows), SCHEMA), tables, clean, now, "2024-01-11", batch_id)
        return tables

    return one


def prices(tables, name):
    return sorted((r["property_id"], float(r["price"])) for r in tables.read(name).collect())


def test_invalid_rows_and_reports_are_kept_by_batch(run):
    tables = run("a", listing("1"), listing("2", price="x"), listing("3", price="-1"), listing("4", district=" "))
    report = lambda: {r["batch_id"]: (r["total"], r["valid"], r["invalid"], r["reasons"], [s["property_id"] for s in r["samples"]]) for r in tables.read("quality").collect()}
    first = {"a": (4, 1, 3, {"type_cast_failed": 1, "numeric_constraint_failed": 1, "missing_required_fields": 1}, ["2", "3", "4"])}
    assert report() == first and tables.read("invalid").count() == 3
    run("b", listing("1"), listing("5"))
    both = first | {"b": (1, 1, 0, {}, [])}
    for again in ("a", "b", "a"):  # committed batches, in any order
        run(again, listing("9", price="x"))
        assert report() == both and tables.read("invalid").count() == 3
    assert prices(tables, "silver") == [("1", 100.0), ("5", 100.0)]


def test_the_newest_version_wins_in_silver_and_in_quarantine(run):
    """Quarantined twice at one time of posting, as an edit keeps it, in both orders; mapped and then not, and the other way
    round; moved from place to place. Then the rules are mended."""
    run("0", listing("a", "Lạ", "100"), listing("b", "Lạ", "300"), listing("c", "Q1", "100"), listing("d", "Lạ", "100"), listing("e", "Q1"), listing("f", "Q1"))
    tables = run("1", listing("a", "Lạ", "300"), listing("b", "Lạ", "100"), listing("c", "Lạ", "300"), listing("d", "Q1", "300"), listing("f", "Q3", "200"), districts=OLD | {"Quận 3": ["Q3"]})
    assert prices(tables, "quarantine") == [("a", 300.0), ("b", 100.0), ("c", 300.0)]
    assert prices(tables, "silver") == [("c", 100.0), ("d", 300.0), ("e", 100.0), ("f", 200.0)]
    gold = lambda: {r["district"]: (r["listing_count"], r["avg_price"]) for r in tables.read("gold").collect()}
    assert gold() == {"Quận 1": (3, 166.67), "Quận 3": (1, 200.0)}
    run("2", districts=NEW)
    assert prices(tables, "silver") == [("a", 300.0), ("b", 100.0), ("c", 300.0), ("d", 300.0), ("e", 100.0), ("f", 200.0)]
    assert not tables.read("quarantine").count() and gold() == {"Quận 1": (2, 200.0), "Quận 3": (1, 200.0), "Huyện Mới": (3, 233.33)}


def test_a_batch_that_breaks_off_anywhere_can_be_repeated(run, monkeypatch):
    """Each attempt gets further than the one before; what it has written stays."""
    run("0", listing("1"), listing("2", "Lạ"), listing("3", price="x"))
    rows = [listing("1", price="150"), listing("2", "Lạ", "250"), listing("4"), listing("5", price="-1")]
    for at, nth in (("replace_batch", 4), ("upsert", 1), ("overwrite", 2), ("upsert", 3)):
        real, calls = getattr(store.TableStore, at), []

        def fails(self, *args, real=real, calls=calls, nth=nth, **how):
            calls.append(args)
            out = real(self, *args, **how)
            if len(calls) == nth:
                raise RuntimeError("broke off")
            return out

        monkeypatch.setattr(store.TableStore, at, fails)
        with pytest.raises(RuntimeError):
            run("1", *rows)
        monkeypatch.setattr(store.TableStore, at, real)
    tables = run("1", *rows)
    assert prices(tables, "silver") == [("1", 150.0), ("4", 100.0)] and prices(tables, "quarantine") == [("2", 250.0)]
    assert sorted((r["batch_id"], r["total"], r["invalid"]) for r in tables.read("quality").collect()) == [("0", 3, 1), ("1", 4, 1)]
    assert tables.read("invalid").count() == 2 and tables.read("bronze").count() == 7 and tables.read("cdc_state").count() == 5


def gold_of(tables):
    return {r["district"]: (r["listing_count"], r["avg_price"], r["median_price"]) for r in tables.read("gold").collect()}


@pytest.mark.parametrize("at", ["silver", "gold_cells", "gold"])
def test_gold_of_places_that_are_left_and_released_survives_a_stop(run, monkeypatch, at):
    """One listing moves away from a place that others stay in, one from a place that is empty then, and one is released from
    quarantine; the batch stops once Silver, the cells or Gold is committed, and is repeated."""
    run("0", listing("a"), listing("b", price="300"), listing("c", "Q3"), listing("d", "Lạ"), districts=OLD | {"Quận 3": ["Q3"]})
    real, stopped = store.TableStore._commit, []

    def stops(self, name, *args):
        out = real(self, name, *args)
        if name == at and not stopped:
            stopped.append(name)
            raise RuntimeError("stopped")
        return out

    monkeypatch.setattr(store.TableStore, "_commit", stops)
    rows, rules = [listing("a", "Q7"), listing("c", "Q7", price="200")], NEW | {"Quận 3": ["Q3"], "Quận 7": ["Q7"]}
    with pytest.raises(RuntimeError):
        run("1", *rows, districts=rules)
    tables = run("1", *rows, districts=rules)
    assert stopped and gold_of(tables) == {"Quận 1": (1, 300.0, 300.0), "Quận 7": (2, 150.0, 100.0), "Huyện Mới": (1, 100.0, 100.0)}


def test_only_parts_that_were_written_since_are_made_anew(spark, tmp_path):
    tables, asked = store.TableStore(spark, str(tmp_path), buckets=8), []
    make = lambda rows, part: asked.append(rows) or rows.groupBy(part, "place").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
    row = lambda ids, v: spark.createDataFrame([(str(i), f"p{i % 3}", v) for i in ids], "id string, place string, v long")
    totals = lambda: {r["place"]: (r["n"], r["v"]) for r in tables.read("sums").groupBy("place").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()}
    tables.upsert("t", row([], 1), ["id"])
    tables.keep_up("sums", "t", make)
    assert totals() == {}
    tables.upsert("t", row(range(60), 1), ["id"])
    g = tables.keep_up("sums", "t", make)
    held = set(tables.read("sums").inputFiles())
    assert totals() == {f"p{k}": (20, 20) for k in range(3)} and tables.keep_up("sums", "t", make) == g and len(asked) == 2
    tables.upsert("t", row([7], 5), ["id"])
    tables.keep_up("sums", "t", make)
    now = set(tables.read("sums").inputFiles())
    assert totals() == {"p0": (20, 20), "p1": (20, 24), "p2": (20, 20)} and len(asked[-1].inputFiles()) == 1 and len(held - now) == len(now - held) == 1
    tables.upsert("t", row(range(60), 0), ["id"], where="v > 0")  # all rows go, and their parts with them
    tables.keep_up("sums", "t", make)
    assert totals() == {} and tables.read("t").count() == 0


def test_gold_of_cells_and_of_all_rows_agree(spark, tmp_path):
    import random

    rng, now = random.Random(3), F.lit("2024-01-11 00:00:00").cast("timestamp")
    clean = lambda d: cleaning.standardize(d, {"city": {"Hồ Chí Minh": ["HCM"]}, "district": {"Quận 1": ["Q1"], "Quận 3": ["Q3"]}})
    both = [store.TableStore(spark, str(tmp_path / k), buckets=4) for k in ("cells", "rows")]
    for batch in ("0", "1"):
        rows = [listing(str(rng.randrange(150)), rng.choice(["Q1", "Q3"]), str(rng.randrange(1, 10**6)), f"2024-01-0{rng.randrange(1, 9)}T00:00:0{batch}Z") for _ in range(100)]
        for tables, exact in zip(both, (False, True), strict=True):
            process_batch(spark.createDataFrame(rows, SCHEMA), tables, clean, now, "2024-01-11", batch, exact=exact)
    cells, exact = ([r.asDict() for r in t.read("gold").orderBy("district").collect()] for t in both)
    assert [c.keys() == e.keys() for c, e in zip(cells, exact, strict=True)] == [True, True]
    for c, e in zip(cells, exact, strict=True):  # sketches of fewer values than they keep are exact
        assert {k: v for k, v in c.items() if not isinstance(v, float)} == {k: v for k, v in e.items() if not isinstance(v, float)}
        assert {k: v for k, v in c.items() if isinstance(v, float)} == pytest.approx({k: v for k, v in e.items() if isinstance(v, float)}, abs=0.02)


def files(top):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet")}


def test_upserts_leave_the_files_of_other_parts_alone(spark, tmp_path):
    tables = store.TableStore(spark, str(tmp_path), buckets=16)
    rows = spark.range(4000).select(F.col("id"), F.lit("old").alias("v"), F.sha2(F.col("id").cast("string"), 256).alias("weight"))
    tables.upsert("t", rows, ["id"])
    before = files(tmp_path / "t")
    paths = lambda: set(tables.read("t").inputFiles())
    held = paths()
    tables.upsert("t", rows.filter("id = 7").withColumn("v", F.lit("new")), ["id"])
    added = {f: n for f, n in files(tmp_path / "t").items() if f not in before}
    assert before == {f: n for f, n in files(tmp_path / "t").items() if f in before}
    assert len(held & paths()) == len(held) - 1 and sum(added.values()) < sum(before.values()) / 8
    assert tables.read("t").filter("v = 'new'").count() == 1 and tables.read("t").count() == 4000 and tables.read("t", 0).filter("v = 'new'").count() == 0
    tables.upsert("t", rows.filter("id = 7").withColumn("extra", F.lit(1)), ["id"])  # a new column is null where it was not written
    assert tables.read("t").filter("extra is null").count() == 3999
    day = lambda d, n: spark.createDataFrame([("x", n, d)], "place string, n int, day string")
    tables.upsert_partitions("g", day("1", 1), ["place"], "day")
    one = set(tables.read("g").inputFiles())
    tables.upsert_partitions("g", day("2", 2), ["place"], "day")
    tables.upsert_partitions("g", day("2", 3), ["place"], "day")
    assert one < set(tables.read("g").inputFiles()) and sorted((r["day"], r["n"]) for r in tables.read("g").collect()) == [("1", 1), ("2", 3)]


def test_appends_and_batches_leave_earlier_generations_alone(spark, tmp_path):
    tables = store.TableStore(spark, str(tmp_path))
    row = lambda n: spark.createDataFrame([(n,)], "n int")
    tables.append("t", row(1))
    tables.append("t", row(2))
    assert [tables.read("t", g).count() for g in (0, 1)] == [1, 2]
    tables.replace_batch("b", row(1), {"batch": "x"})
    tables.replace_batch("b", row(5), {"batch": "y"})
    tables.replace_batch("b", row(7), {"batch": "x"})
    assert [sorted(r["n"] for r in tables.read("b", g).collect()) for g in range(3)] == [[1], [1, 5], [5, 7]]
    real, failed = tables._commit, []
    tables._commit = lambda *a: failed.append(a) or (_ for _ in ()).throw(RuntimeError())
    with pytest.raises(RuntimeError):
        tables.append("t", row(9))
    assert tables.read("t").count() == 2
    tables._commit = real
    tables.append("t", row(3))
    assert sorted(r["n"] for r in tables.read("t").collect()) == [1, 2, 3]


def test_merges_by_sequence(spark):
    row = lambda *rows: spark.createDataFrame(list(rows), "k string, s int, v string")
    merged = store.merge_upsert(row(("a", 1, "t"), ("b", 3, "t"), ("c", 2, "t"), ("d", None, "t"), ("e", 1, "t")), row(("a", 2, "s"), ("b", 2, "s"), ("c", 2, "s"), ("d", 0, "s"), ("e", None, "s"), ("f", None, "s")), ["k"], sequence="s")
    assert sorted((r["k"], r["v"]) for r in merged.collect()) == [("a", "s"), ("b", "t"), ("c", "s"), ("d", "s"), ("e", "t"), ("f", "s")]


def test_drops_and_overflows_are_counted(spark):
    ads = [{"list_id": 1}, {"subject": "no id"}, {"list_id": 2, "subject": None}, {"list_id": 3, "price": "x"}, {"list_id": 4, "size": []}, {"list_id": 5, "list_time": "y", "area_name": None}, "no ad", {"list_id": 6, "price": 1}]
    rows, counted = readers.normalize_counted(spark.createDataFrame([(json.dumps(a),) for a in ads] + [(None,)], "record string"))
    assert sorted(r["property_id"] for r in rows.collect()) == sorted(r["property_id"] for r in readers.normalize(spark.createDataFrame([(json.dumps(a),) for a in ads], "record string")).collect()) == ["1", "6"]
    assert readers.counts_of(spark, counted).first().asDict() == {"records": 9, "no_ad": 2, "without_id": 1, "null_field": 2, "bad_number": 2, "kept": 2}
    cast, lost = readers.counted_casts(spark.createDataFrame([(1.5, "2"), (1e12, "x"), (None, None)], "a double, b string"), {"a": "decimal(8,2)", "b": "decimal(5,1)"})
    assert sorted(map(str, cast.collect())) and lost.get == {"a": 1, "b": 1}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(above, i, x, b):
    row = [i]
    for j, y in enumerate(b, 1):
        row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row


@pytest.mark.parametrize("most", [0.1, 0.3, 0.39, 0.6, 0.9])
def test_similar_texts_are_all_found(spark, most):
    """Empty, one-letter, repetitive and random texts, and texts of two groups."""
    import random

    rng = random.Random(int(most * 100))
    texts = ["", "a", "b", "ab", "aaaa", "aaaaaaaaaa", "aaaaaaaaab", "abababab", "babababa", "nhà phố đẹp", "nha pho dep"]
    for _ in range(40):
        base = "".join(rng.choice("abcde ") for _ in range(rng.randint(2, 24)))
        texts += [base, base[1:] + "x", base[: len(base) // 2] + "yz" + base[len(base) // 2 + 1 :]]
    texts = sorted(set(texts))
    frame = spark.createDataFrame([("g", t) for t in texts] + [("h", t) for t in texts[::3]] + [("g", texts[0])], "place string, title string")
    found = {(r["place"], r["a"], r["b"]): r["d"] for r in cleaning.similar_texts(frame, "place", "title", most).collect()}
    want = {}
    for place, own in (("g", texts), ("h", texts[::3])):
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                d = edits(a, b) / max(len(a), len(b))
                if d <= most + 1e-9:
                    want[place, a, b] = d
    assert found == want
