import os

import pytest
from pyspark.sql import functions as F

from reviewgrain.operators.scaling import scratch_path
from reviewgrain.sources import aspect_store, files, stages


def test_csv_round_trip_with_odd_headers(spark, sample):
    path = scratch_path(spark, "csv")
    odd = sample.withColumnRenamed("uniq_id", "uniq _id").withColumnRenamed("review_date", "review _date")
    files.save(odd, path, "csv")
    back = files.read_csv(spark, path)
    assert set(back.columns) == set(sample.columns)
    assert sorted(r["review"] for r in back.collect()) == ["Sturdy enough", "Too dim", "Wobbles"]
    assert files.missing_columns(back.drop("rating")) == ["rating"]


def test_missing_file_raises(spark):
    with pytest.raises(Exception):
        files.read_csv(spark, scratch_path(spark, "nothing")).count()


def test_source_is_read_once(spark, sample):
    path = scratch_path(spark, "csv")
    files.save(sample, path, "csv")
    source = files.ReviewSource(spark, path)
    assert source.load() is source.load()
    assert source.load(reload=True).count() == 3


def test_stages_resume_from_their_predecessor(spark, sample):
    store = stages.StageStore(spark, scratch_path(spark, "stages"))
    assert store.best_available() is None
    steps = {"load": lambda _: sample, "preprocess": lambda t: t.where("row_id > 0"), "report": lambda t: t.limit(1)}
    assert store.run(steps).count() == 1
    assert store.run({"analyse": lambda t: t.select("row_id")}, only="analyse").count() == 2
    assert store.best_available().columns == ["row_id"]
    with pytest.raises(ValueError):
        store.run(steps, only="nope")


def test_store_can_be_cleared(spark):
    store = aspect_store.AspectStore(spark, scratch_path(spark, "store"))
    store.clear()
    assert store.load().count() == 0
    stats = aspect_store.stats(store.load()).first()
    assert stats["status"] == "empty" and stats["n_documents"] == 0


def test_store_can_be_updated_from_itself(spark):
    store = aspect_store.AspectStore(spark, scratch_path(spark, "store"))
    assert store.load().count() == 0
    one = spark.createDataFrame([("a", "c", "x", "s", None, 1, None, None, None)], aspect_store.DOCUMENT_SCHEMA)
    store.save(one)
    store.save(aspect_store.add_documents(store.load(), one.withColumn("doc_id", F.lit("b"))))
    assert sorted(r["doc_id"] for r in store.load().collect()) == ["a", "b"]


def test_a_failing_save_leaves_the_old_rows(spark, sample):
    path = scratch_path(spark, "kept")
    files.save(sample, path)
    with pytest.raises(Exception):
        files.save(sample.withColumn("bad", F.raise_error(F.lit("no"))), path)
    assert spark.read.parquet(path).count() == sample.count()
    files.save(spark.read.parquet(path).limit(1), path)
    assert spark.read.parquet(path).count() == 1


def test_one_csv_is_written_by_many_tasks(spark, monkeypatch):
    texts = ["plain", None, "", ' "quoted", and\nbroken ', "é\r\nx", "\\", "5\" wide", ",", "\n", "#", "long line " * 40]
    rows = spark.createDataFrame([(i, texts[i % 11], None if i % 7 == 0 else i / 4) for i in range(200)], "id long, `odd name` string, x double").repartition(7, "id")
    plain, path = scratch_path(spark, "plain"), scratch_path(spark, "one")
    files.save(rows.coalesce(1), plain, "csv")
    monkeypatch.setattr(files, "COPIED", 300)
    monkeypatch.setattr(files, "HELD", 77)
    copied = []
    monkeypatch.setattr(files, "_copy", lambda spark, pieces, target, copy=files._copy: (copied.append(pieces), copy(spark, pieces, target)))
    for made, same in ((rows, plain), (rows.limit(0), None), (rows, plain)):  # in the place of what is there
        files.save_one_csv(made, path)
        one = spark.read.format("binaryFile").load(path).collect()
        want = bytes(spark.read.format("binaryFile").load(same).first().content) if same else b"id,odd name,x\n"
        assert len(one) == 1 and bytes(one[0].content) == want
    # a file of rows for every partition, so no task read them all
    assert len(copied[0]) == 1 + 7 and sum(size for _, size in copied[0]) == len(want) and len(copied[1]) <= 2
    assert os.listdir(path.rsplit("/", 1)[0]) == ["one"]


def test_one_csv_that_fails_leaves_the_old_file(spark):
    path = scratch_path(spark, "one")
    files.save_one_csv(spark.range(3), path)
    folder = path.rsplit("/", 1)[0]
    with pytest.raises(Exception):
        files.save_one_csv(spark.range(9).select(F.raise_error(F.lit("no")).alias("id")), path)
    assert spark.read.csv(path, header=True).count() == 3 and os.listdir(folder) == ["one"]


def test_a_store_without_offsets_gets_one_file_from_one_task(spark, monkeypatch):
    path = scratch_path(spark, "one")
    monkeypatch.setattr(files, "_local", lambda *_: False)
    files.save_one_csv(spark.range(30).repartition(5), path)
    assert spark.read.format("binaryFile").load(path).count() == 1 and spark.read.csv(path, header=True).count() == 30
