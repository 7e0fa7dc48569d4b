"""The queries over the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from treeflat.llm import collocations, decontaminate, exact_dedup, html_extract, jaccard_join, langid, lm, quality, sentencepiece_sample, sharding, token_counts, vector_codes, warc
from treeflat.llm.common import crc32_of_id, table


def sampling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    sampled = sentencepiece_sample.sample(table(spark, sf_dir, "documents"), k=2)
    return sampled.select("doc_id", "rank", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed", "log_inclusion", "round_trip")


def decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_report(table(spark, sf_dir, "pages"))


def model_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc32_of_id(F.col("doc_id")) % 7 == 2, F.lit(False))
    model = lm.train(docs.filter(~held_out), order=3)
    return lm.score(docs, model).select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


def sharding_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), 40)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc32_of_id(F.col("doc_id")) % 5 == 0, F.lit(False))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(~held_out)
    vectors = quality.word_vectors(docs)
    model = quality.train(docs, labels, vectors)
    return quality.score(docs, vectors, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_classes(table(spark, sf_dir, "documents"))


def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc32_of_id(F.col("doc_id")) % 4 == 2, F.lit(False))
    model = langid.fit(docs.filter(~held_out))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def extraction_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:  # the driver reads it, executors get its content
        return token_counts.token_counts(table(spark, sf_dir, "documents"), f.read())


def collocations_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def vector_codes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_sentencepiece": sampling_query,
    "op2_decontamination": decontamination_query,
    "op3_warc": warc_query,
    "op4_kneser_ney": model_query,
    "op5_sampled_splitters": sharding_query,
    "op6_quality": quality_query,
    "op7_jaccard_join": join_query,
    "op8_language": language_query,
    "op9_tag_path_ratios": extraction_query,
    "op10_exact_dedup": exact_dedup_query,
    "op11_token_counts": token_counts_query,
    "op12_collocations": collocations_query,
    "op13_vector_codes": vector_codes_query,
}

#: One assignment of all parts to the entries of the codebook ``{books}``; floor division of integers of either sign.
_ASSIGNED = """
    SELECT vec_id, label, row, part, x, min(struct_pack(d := list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), entry := entry)) AS best
    FROM cut JOIN {books} USING (part) GROUP BY ALL"""
_IMPROVED = """
    SELECT b.part, b.entry, coalesce(m.c, b.c) AS c
    FROM {books} b LEFT JOIN (
        SELECT part, entry, list(mean ORDER BY i) AS c FROM (
            SELECT part, best.entry AS entry, i, (sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS mean
            FROM {rows}, (SELECT unnest(range(1, width + 1)) AS i FROM size) GROUP BY 1, 2, 3
        ) GROUP BY 1, 2
    ) m ON b.part = m.part AND b.entry = m.entry"""

ORACLE = {
    "op10_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_collocations": """
        WITH pieces AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
                SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
                FROM documents
            )
        ),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY 1),
        runs AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS phrase
            FROM pieces, (SELECT unnest([1, 2, 3]) AS k)
        ),
        f AS (SELECT lang, k, phrase, count(*) AS n, string_split(phrase, ' ') AS w FROM runs GROUP BY 1, 2, 3 HAVING count(*) >= 10),
        cuts AS (
            SELECT c.lang, c.phrase, c.n AS a, l.n AS l, r.n AS r, place, (1000000::HUGEINT * c.n * c.n // (l.n::HUGEINT * r.n))::BIGINT AS score
            FROM (SELECT *, unnest(range(1, k)) AS place FROM f WHERE k > 1) c
            JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : place], ' ')
            JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[place + 1 : c.k], ' ')
        ),
        lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1),
        within AS (
            SELECT lang, phrase, max(n) AS longest
            FROM (SELECT lang, n, array_to_string(w[1 : 2], ' ') AS phrase FROM f WHERE k = 3 UNION ALL SELECT lang, n, array_to_string(w[2 : 3], ' ') FROM f WHERE k = 3)
            GROUP BY 1, 2
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM lowest JOIN totals USING (lang)
        WHERE NOT EXISTS (SELECT 1 FROM within x WHERE x.lang = lowest.lang AND x.phrase = lowest.phrase AND 100 * x.longest >= 50 * a)
        QUALIFY rank <= 2000
    """,
    "op13_vector_codes": f"""
        WITH kept AS (
            SELECT vec_id, label, row_number() OVER () AS row, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
        ),
        size AS (SELECT max(len(v)) // 16 AS width FROM kept),
        cut AS (SELECT vec_id, label, row, part, v[part * width + 1 : part * width + width] AS x FROM kept, size, (SELECT unnest(range(16)) AS part)),
        smallest AS (SELECT vec_id, min(v) AS v, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept WHERE vec_id IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 64),
        books0 AS (SELECT part, entry, v[part * width + 1 : part * width + width] AS c FROM smallest, size, (SELECT unnest(range(16)) AS part)),
        rows0 AS ({_ASSIGNED.format(books="books0")}),
        books1 AS ({_IMPROVED.format(books="books0", rows="rows0")}),
        rows1 AS ({_ASSIGNED.format(books="books1")}),
        books2 AS ({_IMPROVED.format(books="books1", rows="rows1")}),
        rows2 AS ({_ASSIGNED.format(books="books2")}),
        coded AS (
            SELECT vec_id, label, row, string_agg(lpad(lower(hex(best.entry)), 2, '0'), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
            FROM rows2 GROUP BY 1, 2, 3
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM books2) AS codebooks_sha256
        FROM coded
    """,
}
