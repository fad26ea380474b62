"""What queries leave on disk while they run: shuffle files, tables of a step that is done, and earlier generations."""

import os
import time

import pytest
from pyspark.sql import functions as F

from parcelwise.operators import changes, cleaning
from parcelwise.plans import listings, streams
from parcelwise.sources import readers, store


def files(root, part=""):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if part in f and not f.endswith(".crc")}


@pytest.fixture
def shared(spark, tmp_path, monkeypatch):
    """The folder of scratch tables, empty."""
    paths = iter(range(10_000))
    monkeypatch.setattr(store, "scratch", lambda _: f"{tmp_path}/{next(paths)}")
    monkeypatch.setattr(streams, "scratch", store.scratch)
    monkeypatch.setattr(listings, "scratch", store.scratch)
    return str(tmp_path)


def data(root):
    return files(root, "part-")


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    local = spark.sparkContext.getConf().get("spark.local.dir")
    rows, before = spark.range(1000).repartition(3, "id"), files(local, "shuffle_")
    conf = spark.conf.get(store.CLEANUP)
    store.save(rows, f"{tmp_path}/rows")
    left = lambda: {f for f in files(local, "shuffle_") - before if f.endswith(".data")}
    until = time.time() + 10
    while left() and time.time() < until:  # executors delete them in the background
        time.sleep(0.1)
    assert not left()
    assert spark.conf.get(store.CLEANUP) == conf  # the session is as it was
    assert spark.read.parquet(f"{tmp_path}/rows").count() == rows.count() == 1000


def test_tables_of_a_step_go_with_it(spark, shared):
    with store.passing(spark):
        inner = store.written(spark.range(5))
        assert inner.count() == 5 and data(shared)
    assert not data(shared)
    with pytest.raises(ValueError), store.passing(spark):
        store.written(spark.range(5))
        raise ValueError
    assert not data(shared) and store.written(spark.range(5)).count() == 5


def test_vacuum_keeps_what_the_latest_generation_refers_to(spark, tmp_path):
    tables = store.TableStore(spark, str(tmp_path), buckets=4)
    for value in range(3):
        tables.upsert("t", spark.range(8).filter(F.col("id") != value).withColumn("v", F.lit(value)), ["id"])
    tables.replace_batch("b", spark.range(2), {"batch": "0"})
    tables.replace_batch("b", spark.range(3), {"batch": "1"})
    want = sorted(map(tuple, tables.read("t").collect()))
    tables.vacuum("t", "b", "absent", keep=2)
    assert tables.read("t", 1).count() == 8
    tables.vacuum("t", "b")
    assert sorted(map(tuple, tables.read("t").collect())) == want and tables.read("b").count() == 5
    assert data(f"{tmp_path}/t/g=0") | data(f"{tmp_path}/t/g=1") == set() and tables.generation("t") == 2
    tables.upsert("t", spark.range(1).withColumn("v", F.lit(9)), ["id"])
    assert tables.read("t").count() == 8 and tables.read("t").filter("v = 9").count() == 1


def test_a_stream_keeps_only_its_tables_and_compressed_ads(spark, sf, shared):
    """nothing of a batch's steps is left, no attempt's table that a later one replaced, and ads are landed compressed."""
    assert streams.stream_layers(spark, sf).count() == 14
    ads = [f for f in data(shared) if "/landing/" in f]
    assert ads and all(f.endswith(".txt.gz") for f in ads)
    tables = [f for f in data(shared) if "/store/" in f and "_pointer" not in f]
    assert len({f.split("/landing/")[0].split("/store/")[0] for f in data(shared)}) == 2  # the stream's folder and the listings
    assert len({f.split("/g=")[1].split("/")[0] for f in tables if "/store/cdc_state/" in f}) == 1
    assert len([f for f in tables if "/store/bronze/g=0/" in f]) == 0  # of the first attempt


def test_batches_keep_only_their_tables_and_compressed_ads(spark, sf, shared):
    """two batches and a late replay."""
    assert streams.layers(spark, sf).count() == 14
    ads = [f for f in data(shared) if "/landing/" in f]
    assert ads and all(f.endswith(".txt.gz") for f in ads)
    assert len({f.split("/landing/")[0].split("/store/")[0] for f in data(shared)}) == 2  # the batches' folder and the listings
    for name in ("silver", "cdc_state", "changes", "quarantine"):
        assert len({f.split("/g=")[1].split("/")[0] for f in data(shared) if f"/store/{name}/g=" in f}) == 1, name


def test_landings_keep_one_state_and_no_marked_rows(spark, sf, shared):
    """of the rows that were marked only those that changed are left, and of the state the latest."""
    assert streams.incremental(spark, sf).count() == 2
    kept = {(f.split("/store/")[1].split("/")[0], f.split("/g=")[1].split("/")[0]) for f in data(shared) if "/g=" in f}
    assert kept == {("changed", "0"), ("changed", "1"), ("state", "1")}
    assert len({f.split("/landing/")[0].split("/store/")[0] for f in data(shared)}) == 2
    assert all(f.endswith(".zstd.parquet") for f in data(shared) if "_pointer" not in f)


def test_changes_shuffle_no_fingerprints(spark, tmp_path):
    """a fingerprint does not compress, so it is made where its row has arrived."""
    spark.range(5).selectExpr("cast(id as string) as k", "id as v").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    marked = changes.detect_changes(rows, spark.createDataFrame([], "k string, fingerprint string"), "k", ["k", "v"], "v")
    plan = marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    first = plan[plan.rindex("Exchange"):]  # the shuffle next to the files
    assert "md5" in plan and "md5" not in first and sorted(r["status"] for r in marked.collect()) == ["NEW"] * 5


def test_raw_snapshots_are_compressed_and_not_shuffled_by_their_text(spark, sf, shared, monkeypatch):
    """F8: a file for each array, as before, and what is read back is all of it."""
    texts = spark.createDataFrame([(f'[{{"list_id":"{i}"}}]',) for i in range(4)], "value string").coalesce(1)
    shuffled = []
    real = readers.save
    monkeypatch.setattr(readers, "save", lambda df, *a, **how: (shuffled.append("RepartitionByExpression" in df._jdf.queryExecution().optimizedPlan().toString()), real(df, *a, **how)))
    readers.write_array_snapshot(texts, f"{shared}/raw", "1")
    assert shuffled == [False] and len(data(f"{shared}/raw")) == 4 and all(f.endswith(".txt.gz") for f in data(f"{shared}/raw"))
    assert sorted(r[0] for r in readers.snapshot_records(spark, f"{shared}/raw").collect()) == [f'{{"list_id":"{i}"}}' for i in range(4)]


def test_pairs_shuffle_rows_once_and_titles_as_counts(spark, tmp_path):
    """rows are dealt by place and title for both sides of the pairs, in one shuffle; titles are counted before theirs."""
    rows = [(f"{i}", f"title {i % 3}", 100.0 + i, 50.0, f"g{i % 2}") for i in range(40)] + [("0", "title 0", 100.0, 50.0, "g0")] * 3
    spark.createDataFrame(rows, "k string, t string, p double, s double, g string").write.parquet(f"{tmp_path}/rows")
    pairs = cleaning.resolve_entities(spark.read.parquet(f"{tmp_path}/rows"), "k", "t", "p", "s", "g")
    ids = lambda line: line.strip(" :+-").split("[plan_id")[0]
    dealt = [ids(x) for x in pairs._jdf.queryExecution().executedPlan().toString().split("\n") if "REPARTITION_BY_COL" in x]
    assert len(dealt) == 2
    found = sorted((r["a"], r["b"]) for r in pairs.collect())
    assert len(found) == len(set(found)) == 2 * 20 * 19 // 2  # all of a place, and a repeated row once


def test_models_are_fitted_on_small_partitions_of_what_is_deleted_then(spark, shared, monkeypatch):
    """partitions of the rows that models see grow in number and not in size, and only the district means stay."""
    from parcelwise.operators import market, models

    rows = [(str(i), "ban nha" if i % 2 else "cho thue", "a", f"C{i % 3}", f"D{i % 4}", float(i + 1), 50.0, i % 4, "x" if i % 2 else "y") for i in range(200)]
    frame = spark.createDataFrame(rows, "property_id string, title string, source_category string, city string, district string, price double, area_sqm double, bedrooms int, label string")
    seen, real = [], models.LogisticRegression.fit

    def fit(self, data, *args):
        seen.extend(data.groupBy(F.spark_partition_id()).count().toPandas()["count"].tolist())
        return real(self, data, *args)

    monkeypatch.setattr(models.LogisticRegression, "fit", fit)
    monkeypatch.setattr(models, "HELD", 20)
    model = models.fit_models(market.build_features(frame).coalesce(1), "label", ("logistic",))
    assert sum(seen) == 200 and max(seen) <= 30 and len(seen) >= 8
    assert len({f.rsplit("/", 1)[0] for f in data(shared)}) == 1 and model.means.count() == 4
    assert models.predict(model, market.build_features(frame)).filter("label_ml = label").count() == 200
    assert models.sliced(spark.range(50), 50).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_a_lasting_table_stays(spark, shared):
    with store.passing(spark):
        store.written(spark.range(2))
        kept = store.written(spark.range(3), lasting=True)
    assert kept.count() == 3 and len({f.rsplit("/", 1)[0] for f in data(shared)}) == 1
