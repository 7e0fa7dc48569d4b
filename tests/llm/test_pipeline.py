"""The pipeline's stages on the smallest tables, and the queries that SQL can express."""

import math
import zlib

import duckdb
import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from treeflat.llm import decontaminate, langid, queries, sentencepiece_sample
from treeflat.llm.words import NOT_WORD  # noqa: F401
from tests.llm.test_operators import brute_classes

SF = "/root/testdata/sf0.001"


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    compressors = langid._compressors(langid.fit(docs))
    rows = [r for r in rows if not langid.classify(compressors, r[1])[3]]
    best = {}
    for i, t in rows:
        best[t] = max(i, best.get(t, i))
    rows = sorted((i, t) for t, i in best.items())
    rows = [r for r, c in zip(rows, brute_classes(rows)) if c[2] == r[0]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    plain = lambda t: " " + " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in t.lower()).split()) + " "
    held = {i for i, t in rows if any(plain(x) in plain(t) for _, x in items)}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) <= {i for i, _ in rows} - held
    # a passage in pieces is found by tiles only
    rest = {i for i, _ in rows} - held - set(got)
    pairs = decontaminate.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert rest <= {p.doc_id for p in pairs}
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in got.values())


def test_encode_samples_without_replacement(spark):
    """Every row with all the segmentations that op1_sentencepiece samples for it: distinct, ranked, the best first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    got = {}
    for r in corpus_pipeline.encode(spark, docs, SF).collect():
        got.setdefault(r.doc_id, {})[r.rank] = r
    sampled = sentencepiece_sample.sample(docs, k=2).collect()
    assert {(i, k, tuple(r.ids), r.log_prob) for i, rows in got.items() for k, r in rows.items()} == {(r.doc_id, r.rank, tuple(r.ids), r.log_prob) for r in sampled}
    assert any(len(rows) == 2 for rows in got.values())
    assert all(len({tuple(r.ids) for r in rows.values()}) == len(rows) for rows in got.values())


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_decontaminate_takes_texts_in_bounded_batches(spark, monkeypatch):
    """A worker is sent few megabytes at once; no row is lost by it."""

    def bounded(column, block, coverage, found=decontaminate.matches):
        assert column.nbytes < 6_000_000
        return found(column, block, coverage)

    monkeypatch.setattr(decontaminate, "matches", bounded)
    docs = spark.range(0, 5000, numPartitions=1).selectExpr("id AS doc_id", "repeat(concat('w', id, ' '), 500) AS text")
    assert corpus_pipeline.benchmark(spark, docs, SF).count() == 5000


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    result = con.execute(queries.ORACLE[name])
    df = queries.QUERIES[name](spark, SF).select(*[d[0] for d in result.description])
    assert sorted(map(tuple, df.collect()), key=str) == sorted(result.fetchall(), key=str)


@pytest.mark.parametrize("name", sorted(n for n in queries.QUERIES if n not in queries.ORACLE))
def test_registered_operators_run(spark, name):
    """Each registered operator on the smallest tables; those that answer row by row answer every row once."""
    got = queries.QUERIES[name](spark, SF)
    table, key = ("pages", "page_id") if name == "op9_tag_path_ratios" else ("documents", "doc_id")
    rows = got.collect()
    assert rows
    if name in ("op4_kneser_ney", "op6_quality", "op8_language", "op9_tag_path_ratios", "op11_token_counts"):
        assert sorted(r[key] for r in rows) == sorted(r[key] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())


def test_language_by_plain_sizes(spark):
    """A second reading of op8_language: the size of each window under each dictionary, without the operator's own classify."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held_out = [r.doc_id for r in docs.select("doc_id").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    model = langid.fit(docs.filter(~docs.doc_id.isin(held_out)))
    coders = dict(langid._compressors(model))
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in queries.QUERIES["op8_language"](spark, SF).collect():
        text = texts[r.doc_id]
        assert r.held_out == (r.doc_id in held_out)
        if not text or not any(c.isalpha() for c in text):
            assert r.lang_pred == "und" and r.rejected
            continue
        data = text.lower().encode()
        count = math.ceil(len(data) / langid.WINDOW_BYTES)
        pieces = [data[len(data) * k // count : len(data) * (k + 1) // count] for k in range(count)]
        sizes = sorted(sum(len(c.compress(bytes(64) + w)) for w in pieces) for c in coders.values())
        own = sum(len(coders[r.lang_pred].compress(bytes(64) + w)) for w in pieces)
        assert own == sizes[0] and r.margin == pytest.approx((sizes[1] - own) / sizes[1]) and r.rejected == (r.margin < langid.MIN_MARGIN)


def test_registered():
    names = entry_points.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
