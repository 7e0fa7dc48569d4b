from concurrent.futures import ThreadPoolExecutor
import threading

import pytest
from pyspark.sql import functions as F

from treeflat.operators import classify, quality, upkeep
from treeflat.sinks.store import Published, Store
from treeflat.sinks import tables as sinks

T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def registry(spark, *rows):
    return spark.createDataFrame(list(rows), "uid string, record_hash string, source_file string, ingested_at string").withColumn(
        "ingested_at", F.col("ingested_at").cast("timestamp"))


def test_each_record_gets_exactly_one_status(spark, collect):
    recs = spark.createDataFrame([("a", "1"), ("b", "2x"), ("c", "3"), ("d", None)], "uid string, record_hash string")
    reg = registry(spark, ("a", "1", "f", T1), ("b", "2", "f", T1), ("z", "9", "f", T1), ("d", "4", "f", T1))
    got = classify.classify(recs, reg)
    assert collect(got, "uid", "status") == [("a", "unchanged"), ("b", "changed"), ("c", "new"), ("d", "changed")]
    assert collect(classify.to_process(got), "uid") == [("b",), ("c",), ("d",)]
    assert collect(classify.classify(recs, reg.limit(0)), "status") == [("new",)] * 4


def test_duplicate_registry_ids_use_the_latest(spark, collect):
    recs = spark.createDataFrame([("a", "2")], "uid string, record_hash string")
    reg = registry(spark, ("a", "1", "f", T1), ("a", "2", "f", T2), ("a", "0", "f", None))
    assert collect(classify.classify(recs, reg), "status") == [("unchanged",)]


def test_hot_id_in_records(spark):
    recs = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("uid"),
                                    F.col("id").cast("string").alias("record_hash"))
    got = {r.status: r.records for r in classify.route_counts(classify.classify(recs, registry(spark, ("hot", "3", "f", T1)))).collect()}
    assert got == {"new": 2000, "changed": 999, "unchanged": 1}


def test_delete_stale_only_older_rows_of_changed_ids(spark, collect):
    t = spark.createDataFrame([("a", T1), ("a", T2), ("b", T1), ("a", None)], "id string, ts string").select(
        "id", F.col("ts").cast("timestamp").alias("ingestion_ts"))
    ids = spark.createDataFrame([("a",), ("a",)], "uid string")
    assert upkeep.delete_stale(t, ids, T2).count() == 3
    assert upkeep.delete_stale(t, ids, T2, null_is_old=True).count() == 2
    assert upkeep.delete_stale(t, ids.limit(0), T2).count() == 4


def test_latest_version_keeps_all_rows_of_the_newest_run(spark, collect):
    t = spark.createDataFrame([("a", T1, 1), ("a", T2, 2), ("a", T2, 3), ("b", T1, 4), ("c", None, 5)], "id string, ts string, n int").select(
        "id", F.col("ts").cast("timestamp").alias("ingestion_ts"), "n")
    assert collect(upkeep.latest_version(t), "n") == [(2,), (3,), (4,), (5,)]


def test_orphans_and_keys(spark, collect):
    parent = spark.createDataFrame([("a", 1), ("a", 2)], "id string, k long")
    child = spark.createDataFrame([("a", 1, 1), ("a", 3, 1), (None, 1, 1), ("a", 1, 1)], "id string, k long, c long")
    assert collect(quality.orphans(child, parent, ["id", "k"])) == [("a", 3, 1)]
    assert collect(quality.duplicate_keys(child, ["id", "k", "c"])) == [("a", 1, 1, 2)]


def store(spark, tmp_path, fold_after=8):
    return Store(spark, f"file://{tmp_path}/store", fold_after)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, v string")


def written(tmp_path):
    return sum(p.stat().st_size for p in (tmp_path / "store").rglob("*.parquet"))


def test_upsert_writes_in_proportion_to_the_change(spark, tmp_path, collect):
    """One percent of the ids: about one percent of the bytes, whatever the number of tables."""
    s = store(spark, tmp_path)
    rows = spark.range(40_000).select(F.col("id").cast("string").alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    c = s.begin()
    for t in "abc":
        c.replace(t, rows, "id")
    c.publish()
    before = written(tmp_path)
    c = s.begin()
    some = rows.where("id % 100 = 0").withColumn("v", F.reverse("v"))
    ids = c.replaced(some.select("id"))
    for t in "abc":
        c.upsert(t, some, some.select("id"), "id", ids)
    c.publish()
    assert written(tmp_path) - before < 0.02 * before
    for t in "abc":
        got = s.read(t).join(rows.withColumnRenamed("v", "old"), "id")
        assert got.count() == 40_000 and got.where("v <> old").count() == 400


def test_upsert_of_an_id(spark, tmp_path, collect):
    s = store(spark, tmp_path, 8)
    first = s.begin()
    first.replace("t", frame(spark, *[(str(i), "old") for i in range(200)]), "id")
    assert s.tables() == [] and first.publish() == 1
    change = s.begin()
    change.upsert("t", frame(spark, ("7", "new"), ("7", "new2")), frame(spark, ("7", ""), ("8", "")).select("id"), "id")
    assert s.read("t").count() == 200  # nothing is visible before publishing
    change.publish()
    got = dict(collect(s.read("t").where("id in ('7','8','9')").groupBy("id").agg(F.count("*"))))
    assert got == {"7": 2, "9": 1} and s.read("t").count() == 200


def test_second_writer_fails_and_the_store_stays_readable(spark, tmp_path):
    s = store(spark, tmp_path)
    a, b = s.begin(), s.begin()
    a.replace("t", frame(spark, ("1", "a")), "id")
    b.replace("t", frame(spark, ("1", "b")), "id")
    a.publish()
    with pytest.raises(RuntimeError, match="another writer"):
        b.publish()
    assert [r.v for r in s.read("t").collect()] == ["a"]


def test_racing_writers(spark, tmp_path):
    """Of many that publish one version at the same time exactly one succeeds."""
    s = store(spark, tmp_path)
    rows = frame(spark, ("1", "a"))
    for version in range(1, 4):
        changes = [s.begin() for _ in range(6)]
        changes[0].replace("t", rows, "id")
        for c in changes[1:]:
            c.manifest = dict(changes[0].manifest) | {"batches": {"writer": id(c)}}
        start = threading.Barrier(6)

        def publish(c):
            start.wait()
            try:
                return c.publish()
            except Published:
                return None

        with ThreadPoolExecutor(6) as pool:
            assert sorted(pool.map(publish, changes), key=str) == sorted([version, *[None] * 5], key=str)
        assert s.version() == version and s.read("t").count() == 1
    assert not [n for n in s.files.names(f"{s.root}/manifests") if n.endswith(".tmp")]


def test_many_layers_and_folds(spark, tmp_path, collect):
    """Against a dictionary; ids that come back, go, come twice; an extra column on the way."""
    s, kept = store(spark, tmp_path, 2), {}
    for run in range(7):
        ids = [str(i) for i in range(30) if (i * 7 + run) % (2 + run % 3) == 0]
        rows = [(i, f"{run}.{k}") for i in ids if int(i) % 5 for k in range(1 + int(i) % 2)]  # every fifth id has no rows any more
        kept = {i: v for i, v in kept.items() if i not in ids} | {i: sorted(v for j, v in rows if j == i) for i, _ in rows}
        c, df = s.begin(), spark.createDataFrame(rows, "id string, v string")
        c.upsert("t", df.withColumn("run", F.lit(run)) if run > 3 else df, spark.createDataFrame([(i,) for i in ids], "id string"), "id")
        c.publish()
        want = sorted((i, v) for i, vs in kept.items() for v in vs)
        assert collect(s.read("t"), "id", "v") == sorted(want, key=str)
        s.fold()
        assert collect(s.read("t"), "id", "v") == sorted(want, key=str)
        assert len(s._manifest()["tables"]["t"]["layers"]) <= 2
    assert s.fold() is None


def test_crash_before_publish_then_rerun(spark, tmp_path):
    s = store(spark, tmp_path)
    lost = s.begin()
    lost.upsert("t", frame(spark, ("1", "a")), frame(spark, ("1", "")).select("id"), "id")
    again = s.begin()
    again.upsert("t", frame(spark, ("1", "a")), frame(spark, ("1", "")).select("id"), "id")
    again.publish()
    assert s.read("t").count() == 1


def test_new_columns_and_absent_tables(spark, tmp_path, collect):
    s = store(spark, tmp_path)
    c = s.begin()
    c.replace("t", frame(spark, ("1", "a"), ("2", "b")), "id")
    c.publish()
    c = s.begin()
    c.upsert("t", spark.createDataFrame([("2", "c", "w")], "id string, v string, extra string"), frame(spark, ("2", "")).select("id"), "id")
    c.publish()
    assert collect(s.read("t"), "id", "v", "extra") == [("1", "a", None), ("2", "c", "w")]
    assert s.read("none", "id string").count() == 0


def test_hot_key_upsert(spark, tmp_path):
    s = store(spark, tmp_path)
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"), F.lit("x").alias("v"))
    c = s.begin()
    c.upsert("t", rows, rows.select("id"), "id")
    c.publish()
    c = s.begin()
    c.upsert("t", rows.where("id = 'hot'").limit(5), rows.where("id = 'hot'").select("id"), "id")
    c.publish()
    assert s.read("t").where("id = 'hot'").count() == 5 and s.read("t").count() == 4005


def test_empty_disposition(spark, tmp_path):
    path = f"{tmp_path}/t"
    sinks.write_table(frame(spark, ("1", "a")).limit(0), path, sinks.EMPTY)
    sinks.write_table(frame(spark, ("1", "a")), path, sinks.EMPTY)
    with pytest.raises(ValueError, match="not empty"):
        sinks.write_table(frame(spark, ("1", "a")), path, sinks.EMPTY)
