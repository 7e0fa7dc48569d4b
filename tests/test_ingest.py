import os

from pyspark.sql import functions as F
import pytest

from treeflat import Contracts, Mapping
from treeflat.ingest import Job, bulk_load, ingest, replay
from treeflat.operators import deadletter
from treeflat.sinks import tables as sinks
from treeflat.sinks.store import Store
from treeflat.sources import files, records as R
from treeflat.streaming.ingest import ingest_stream

MAPPING = Mapping.from_xml("""<records><REC table="doc" file_number="doc:fn" y="doc:year"><UID/>
<w table="word" ctr_id="word:wid" t="word:t">word:text</w>
<a><l table="la" ctr_id="la:lid">la:v</l></a><b><l table="lb" ctr_id="lb:lid">lb:v</l></b></REC></records>""")


def fields(**kinds):
    return [{"name": n, "type": k.rstrip("!"), "mode": "REQUIRED" if k.endswith("!") else "NULLABLE"} for n, k in kinds.items()]


RAW = {
    "doc": fields(id="STRING!", fn="INTEGER", year="INTEGER"),
    "word": fields(id="STRING!", wid="INTEGER!", text="STRING"),  # t is not declared
    "la": fields(id="STRING!", lid="INTEGER!", v="STRING"),
    "lb": fields(id="STRING!", lid="INTEGER!", v="STRING"),
}
CONTRACTS = Contracts.from_dict(RAW)


def rec(uid, year="2000", words="<w>x</w>", more=""):
    return f'<REC y="{year}"><UID>{uid}</UID>{words}{more}</REC>'


@pytest.fixture
def job(spark, tmp_path):
    return Job(MAPPING, CONTRACTS, Store(spark, f"file://{tmp_path}/store"), dead_letters=f"file://{tmp_path}/dead")


def write(folder, name, *recs, tail="</records>"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.xml", "w") as f:
        f.write("<records>" + "\n".join(recs) + tail)


def test_two_runs(spark, tmp_path, job, collect):
    src = f"{tmp_path}/in"
    write(src, "a", rec("1"), rec("2", words="<w t='q'>a</w><w>b</w>"), rec("3", more="<b><l>b1</l></b><a><l>a1</l></a>"))
    one = ingest(spark, src, job, "2024-01-01 00:00:00")
    assert one.counts["new"] == 3 and one.dead_letters == 0
    assert collect(job.store.read("word"), "id", "wid", "text") == [("1", 1, "x"), ("2", 1, "a"), ("2", 2, "b"), ("3", 1, "x")]
    assert collect(job.store.read("la"), "id", "lid", "v") == [("3", 2, "a1")]
    assert job.store.read("word").columns == ["id", "wid", "text", "ingestion_ts"]
    assert job.store.read("doc").columns == ["id", "fn", "year", "ingestion_ts", "record_hash"]
    assert ingest(spark, src, job).skipped

    # a second file: one changed (fewer words), one unchanged, one new, one twice
    write(src, "b", rec("2", words="<w>only</w>"), rec("1"), rec("4", year="1999"), rec("4", year="2001"))
    two = ingest(spark, src, job, "2024-02-01 00:00:00")
    assert two.counts == {"new": 1, "changed": 1, "unchanged": 1}
    got = [(i, w, t, str(ts)[:10]) for i, w, t, ts in collect(job.store.read("word"), "id", "wid", "text", "ingestion_ts")]
    assert got == [("1", 1, "x", "2024-01-01"), ("2", 1, "only", "2024-02-01"), ("3", 1, "x", "2024-01-01"), ("4", 1, "x", "2024-02-01")]
    assert [r.year for r in job.store.read("doc").where("id = '4'").collect()] == [2001]
    reg = job.store.read("record_registry")
    assert reg.count() == 4 and reg.select("uid").distinct().count() == 4
    assert sorted(r.record_count for r in job.store.read("file_registry").collect()) == [3, 4]

    # a changed file is processed again, the other stays skipped
    write(src, "b", rec("2", words="<w>third</w>"))
    three = ingest(spark, src, job, "2024-03-01 00:00:00")
    assert three.counts == {"changed": 1}
    assert job.store.read("file_registry").count() == 2


def test_failures_go_to_dead_letters_and_are_seen_again(spark, tmp_path, job, collect):
    src = f"{tmp_path}/in"
    write(src, "a", rec("ok"), "<REC><v>no id</v></REC>", rec("bad", words="<w>x</v>"), rec("pi", words="<?x y?><w>1</w>"),
          rec("year", year="MM"), rec("mixed", words="<w>p<i>q</i>r</w>"), "<REC y='1'><UID>cut</UID>", tail="")
    got = ingest(spark, src, job, "2024-01-01 00:00:00")
    letters = deadletter.read_letters(spark, job.dead_letters)
    assert got.dead_letters == 5
    assert collect(letters, "record_id", "pipeline_step", "error_type") == sorted([
        (None, "SplitXMLRecords", "ValueError"), ("cut", "SplitXMLRecords", "XMLSyntaxError"), ("bad", "ParseXMLRecord", "XMLSyntaxError"),
        ("pi", "ParseXMLRecord", "XMLSyntaxError"), (None, "ValidateSchema", "ValueError")], key=str)
    assert [r[0] for r in collect(job.store.read("doc"), "id")] == ["mixed", "ok"]
    assert ("mixed", 1, "p") in collect(job.store.read("word"), "id", "wid", "text")
    assert not {"bad", "cut"} & {r.uid for r in job.store.read("record_registry").collect()}


def test_file_numbers(spark, tmp_path, job, collect):
    write(f"{tmp_path}/in", "a", rec("1"))
    write(f"{tmp_path}/in", "b", rec("2"))
    job.file_numbers = spark.createDataFrame([("a.xml", 17)], "file_name string, file_number bigint")
    ingest(spark, f"{tmp_path}/in", job)
    assert collect(job.store.read("doc"), "id", "fn") == [("1", 17), ("2", -1)]


def test_bulk_load_appends_and_truncates(spark, tmp_path, job):
    write(f"{tmp_path}/in", "a", rec("1"), rec("2"))
    recs = R.read_records(spark, f"{tmp_path}/in")
    out = f"file://{tmp_path}/out"
    paths = bulk_load(recs, job, out, "2024-01-01 00:00:00", sinks.TRUNCATE)
    bulk_load(recs, job, out, "2024-01-02 00:00:00", sinks.APPEND)
    assert set(paths) == {"doc", "word", "la", "lb"}
    assert sinks.read_table(spark, paths["word"]).count() == 4
    bulk_load(recs, job, out, "2024-01-02 00:00:00", sinks.TRUNCATE)
    assert sinks.read_table(spark, paths["word"]).count() == 2


def test_stream_reads_each_file_once(spark, tmp_path, job, collect):
    src, ck = f"{tmp_path}/in", f"{tmp_path}/ck"
    write(src, "a", rec("1"), rec("2"))
    ingest_stream(spark, src, job, ck, "2024-01-01 00:00:00")
    version = job.store.version()
    ingest_stream(spark, src, job, ck, "2024-01-02 00:00:00")
    assert job.store.version() == version
    write(src, "b", rec("2", words="<w>new</w>"), rec("3"))
    ingest_stream(spark, src, job, ck, "2024-02-01 00:00:00")
    assert collect(job.store.read("word"), "id", "text") == [("1", "x"), ("2", "new"), ("3", "x")]
    assert ingest(spark, src, job).skipped  # the stream's files are in the file registry
    version = job.store.version()
    assert job.store.last_batch(ck) == 1
    assert ingest(spark, src, job, force=True, batch=(ck, 1)).skipped and job.store.version() == version  # a repeated batch
    assert not ingest(spark, src, job, force=True, batch=(ck, 2)).skipped and job.store.last_batch(ck) == 2


def test_fingerprints_of_any_size_and_split(spark, tmp_path):
    src = f"{tmp_path}/in"
    write(src, "a", *[rec(str(i)) for i in range(300)])
    write(src, "same", *[rec(str(i)) for i in range(300)])
    write(src, "other", *[rec(str(i)) for i in range(299)], rec("x"))
    whole = {r.file_path.rsplit("/")[-1]: r.file_md5 for r in files.fingerprints(spark, src).collect()}
    assert whole["a.xml"] == whole["same.xml"] != whole["other.xml"]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        split = {r.file_path.rsplit("/")[-1]: r.file_md5 for r in files.fingerprints(spark, src).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert split == whole


def test_fingerprints_tell_places_apart(spark, tmp_path):
    """The same pieces at other places are another file, however the files are split."""
    src = f"{tmp_path}/in"
    rows = [rec(str(i), words=f"<w>{'open' if i % 2 else 'shut'}</w>") for i in range(200)]
    swap = lambda a, b: [rows[b] if k == a else rows[a] if k == b else r for k, r in enumerate(rows)]
    write(src, "a", *rows)
    write(src, "same", *rows)
    write(src, "order", *swap(12, 157))
    write(src, "value", *[rec(str(i), words=f"<w>{'open' if (i % 2) != (i in (10, 11)) else 'shut'}</w>") for i in range(200)])
    # two swaps at the same distance that undo each other in a sum of hash times place
    write(src, "two", *[rec(str(i), words=f"<w>{'open' if (i % 2) != (i in (10, 11, 31, 32)) else 'shut'}</w>") for i in range(200)])
    write(src, "ids", *[rec({5: "6", 6: "5"}.get(i, str(i)), words=f"<w>{'open' if i % 2 else 'shut'}</w>") for i in range(200)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for size in (before, "700"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found.append({r.file_path.rsplit("/")[-1]: r.file_md5 for r in files.fingerprints(spark, src).collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1] and found[0]["a.xml"] == found[0]["same.xml"]
    assert len(set(found[0].values())) == 5


def test_values_swapped_between_records_are_ingested(spark, tmp_path, job, collect):
    src = f"{tmp_path}/in"
    write(src, "a", rec("1", words="<w>open</w>"), rec("2", words="<w>shut</w>"))
    assert ingest(spark, src, job, "2024-01-01 00:00:00").counts == {"new": 2}
    write(src, "a", rec("1", words="<w>shut</w>"), rec("2", words="<w>open</w>"))
    assert ingest(spark, src, job, "2024-02-01 00:00:00").counts == {"changed": 2}
    assert collect(job.store.read("word"), "id", "text") == [("1", "shut"), ("2", "open")]


def test_names_with_special_characters(spark, tmp_path, job, collect):
    src = f"{tmp_path}/in"
    for n, name in enumerate(["a b", "d[1]", "p%20q", "h#x", "c+d", "e{f}"]):
        write(src, name, rec(f"{n}a"), rec(f"{n}b"))
    job.file_numbers = spark.createDataFrame([("a b.xml", 17), ("p%20q.xml", 18)], "file_name string, file_number bigint")
    assert ingest(spark, src, job, "2024-01-01 00:00:00").counts == {"new": 12}
    assert {r.record_count for r in job.store.read("file_registry").collect()} == {2}
    assert {i: n for i, n in collect(job.store.read("doc"), "id", "fn")} | {"0a": 17, "2b": 18} == {i: n for i, n in collect(job.store.read("doc"), "id", "fn")}
    assert ingest(spark, src, job).skipped


def test_refused_roots_have_no_children_and_return_after_a_repair(spark, tmp_path, job, collect):
    src = f"{tmp_path}/in"
    write(src, "a", rec("ok"), rec("year", year="MM"))
    assert ingest(spark, src, job, "2024-01-01 00:00:00").dead_letters == 1
    assert collect(job.store.read("word"), "id") == [("ok",)]
    assert [r.uid for r in job.store.read("record_registry").collect()] == ["ok"]
    job.contracts = Contracts.from_dict({t: [f for f in fs if f["name"] != "year"] for t, fs in RAW.items()}).augmented("doc")
    job.store = Store(spark, f"file://{tmp_path}/store")
    assert ingest(spark, src, job).skipped
    again = ingest(spark, src, job, "2024-02-01 00:00:00", force=True)
    assert again.counts == {"new": 1, "unchanged": 1}
    assert collect(job.store.read("word"), "id") == [("ok",), ("year",)]


def test_bulk_load_writes_dead_letters(spark, tmp_path, job, collect):
    src, out = f"{tmp_path}/in", f"file://{tmp_path}/out"
    write(src, "a", rec("ok"), rec("bad", words="<w>x</v>"), rec("year", year="MM"))
    paths = bulk_load(R.read_records(spark, src), job, out, "2024-01-01 00:00:00")
    assert collect(sinks.read_table(spark, paths["word"]), "id") == [("ok",)]
    letters = deadletter.read_letters(spark, job.dead_letters)
    assert sorted(r.pipeline_step for r in letters.collect()) == ["ParseXMLRecord", "ValidateSchema"]


def test_record_fingerprint_ignores_order_but_not_content(spark):
    def f(*hashes):
        return spark.createDataFrame([("f", h) for h in hashes], "source_file string, record_hash string")

    one, two, three = (files.record_fingerprints(f(*h)).first().file_md5 for h in (("a", "b", "b"), ("b", "a", "b"), ("a", "b")))
    assert one == two != three


def test_unchanged_files_are_not_read(spark, tmp_path, job, monkeypatch):
    src = f"{tmp_path}/in"
    write(src, "a", rec("1"))
    write(src, "b", rec("2"))
    for name in "ab":
        os.utime(f"{src}/{name}.xml", (1_600_000_000, 1_600_000_000))
    assert ingest(spark, src, job, "2024-01-01 00:00:00").counts == {"new": 2}
    plain, seen = files.profiled, []
    monkeypatch.setattr(files, "profiled", lambda spark, path, *a: seen.append(path) or plain(spark, path, *a))
    assert ingest(spark, src, job).skipped and not seen
    os.utime(f"{src}/a.xml", (1_600_000_001, 1_600_000_001))  # another time, the same content: read once more
    assert ingest(spark, src, job).skipped and [p.rsplit("/")[-1] for p in seen.pop()] == ["a.xml"]
    assert ingest(spark, src, job).skipped and not seen
    write(src, "b", rec("2", words="<w>y</w>"))  # the same length, changed just now: not trusted until the time stamp has settled
    assert ingest(spark, src, job, "2024-02-01 00:00:00").counts == {"changed": 1} and len(seen) == 1
    write(src, "b", rec("2", words="<w>z</w>"))
    assert ingest(spark, src, job, "2024-03-01 00:00:00").counts == {"changed": 1} and len(seen) == 2
    assert ingest(spark, src, job, "2024-04-01 00:00:00", force=True).counts == {"unchanged": 2}


def test_run_with_a_container(spark, tmp_path, job, collect):
    src = f"{tmp_path}/in"
    write(src, "a", rec("1"), tail="</records><drafts>" + rec("2") + "<REC><v>no id, and no letter: a draft</v></REC></drafts><records>" + rec("3") + "<REC/></records>")
    job.container = "records"
    report = ingest(spark, src, job, "2024-01-01 00:00:00")
    assert collect(job.store.read("doc"), "id") == [("1",), ("3",)] and report.counts == {"new": 2}
    assert report.dead_letters <= 1


def test_replay(spark, tmp_path, job, collect):
    """Letters only; what was tried is not tried again, newer versions stay, cut-off records need a repair."""
    src = f"{tmp_path}/in"
    write(src, "a", rec("ok"), rec("bad", words="<w>x</v>"), rec("worse", words="<w>x</u>"), "<REC><w>nameless</w></REC>", tail="<REC><UID>cut</UID><w>y</w>")
    assert ingest(spark, src, job, "2024-01-01 00:00:00").dead_letters == 4
    assert replay(spark, job, run_ts="2024-01-02 00:00:00").counts == {"new": 2}  # the malformed two are tried, and fail again
    assert replay(spark, job).skipped
    assert collect(job.store.read("doc"), "id") == [("ok",)]
    repair = lambda xml: F.replace(F.replace(xml, F.lit("</v>"), F.lit("</w>")), F.lit("<REC><w>"), F.lit("<REC><UID>named</UID><w>"))
    replay(spark, job, repair, "2024-01-03 00:00:00")
    assert collect(job.store.read("doc"), "id") == [("bad",), ("named",), ("ok",)]
    assert replay(spark, job, repair).skipped
    assert sorted(r.attempts for r in job.store.read("replays").collect())[-1] == 2
    # a newer good version of a letter's record stays
    write(src, "b", rec("worse", words="<w>newer</w>"))
    ingest(spark, src, job, "2024-02-01 00:00:00")
    replay(spark, job, lambda xml: F.replace(xml, F.lit("</u>"), F.lit("</w>")), "2024-03-01 00:00:00", force=True)
    assert collect(job.store.read("word").where("id = 'worse'"), "text") == [("newer",)]


def test_run_over_odd_files(spark, tmp_path, job, collect):
    """Hidden closing tags, a declared encoding, an own closing tag; a file in an unknown encoding goes to the dead letters."""
    src = f"{tmp_path}/in"
    write(src, "a", rec("1", words="<w><![CDATA[a</REC>b]]></w>"), rec("2", words="<w>c<!-- </REC> --></w>"), rec("3"))
    with open(f"{src}/b.xml", "wb") as f:
        f.write(('<?xml version="1.0" encoding="ISO-8859-15"?><records>' + rec("4", words="<w>\u20ac</w>") + "</records>").encode("iso-8859-15"))
    with open(f"{src}/c.xml", "wb") as f:
        f.write(b'<?xml version="1.0" encoding="x-none"?><records>' + rec("5").encode() + b"</records>")
    write(src, "d", *(rec(str(i)).replace("REC", "x:REC") for i in (6, 7)))
    report = ingest(spark, src, job, "2024-01-01 00:00:00")
    assert report.counts == {"new": 6} and report.dead_letters == 1
    assert collect(job.store.read("word"), "id", "text") == [("1", "a</REC>b"), ("2", "c"), ("3", "x"), ("4", "\u20ac"), ("6", "x"), ("7", "x")]
    letter = deadletter.read(spark, job.dead_letters).first() if hasattr(deadletter, "read") else spark.read.json(job.dead_letters, recursiveFileLookup=True).first()
    assert letter.error == "unknown encoding X-NONE" and "c.xml" in letter.row
