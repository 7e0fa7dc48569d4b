"""Shared steps of the queries: what is written, and how records are cut."""

import os

from pyspark.sql import functions as F

from catalog import corpora
from treeflat.sources.records import read_records

SF = "/root/testdata/sf0.001"


def test_the_noisy_corpus_is_smaller_than_its_records(spark):
    path = corpora.noisy_corpus(spark, SF)
    folder = path.removeprefix("file://")
    written = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.startswith("part-"))
    records = read_records(spark, path)
    size, n = records.agg(F.sum(F.octet_length("xml")), F.count(F.lit(1))).first()
    assert n == spark.read.parquet(f"{SF}/documents.parquet").count() and written < size / 2


def test_an_id_behind_a_long_attribute(spark, tmp_path):
    (tmp_path / "a.xml").write_text(f"<records><REC a='{'x' * 5000}'><UID> 7 </UID></REC><REC><UID>8</UID><t>{'y' * 5000}</t></REC ></records>")
    assert sorted(r.uid for r in read_records(spark, str(tmp_path)).collect()) == ["7", "8"]
