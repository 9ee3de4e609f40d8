"""The registered queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from riftlog.llm import collocations, dart_minhash, decontaminate, html_text, language_id, license_scan, lz_fingerprint, mixing, quality_model, suffix_dedup, token_counts, toxicity, vector_codes
from riftlog.llm.labelled import fold, held_out


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.allocate(table(spark, sf, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf, "documents"), token_counts.read_vocabulary(), keep=["doc_id"])
    return counted.select("row.doc_id", "n_chars", "n_tokens")


def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark"), keep=["doc_id"])
    return found.select("row.doc_id", F.explode("hits").alias("hit")).select("doc_id", F.col("hit.item").alias("item_id"), "hit.matched_words", "hit.first_word", "hit.last_word")


def op4_suffix_array(spark: SparkSession, sf: str) -> DataFrame:
    spans, _ = suffix_dedup.repeats(table(spark, sf, "documents"))
    return spans.select(F.col("id").alias("doc_id"), F.col("first").alias("first_word"), (F.col("last") - 1).alias("last_word"))


def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf, "documents"), keep=["doc_id"])
    return found.select("row.doc_id", *[c for c in found.columns if c != "row"])


def op6_dart_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return dart_minhash.near_duplicates(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


def op7_lz_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return lz_fingerprint.neighbours(table(spark, sf, "documents"))


def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language_id.predict(docs, language_id.fit(docs, where=fold(F.col("doc_id")) != 1), keep=["doc_id"])
    return found.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", F.col("cosine").alias("score"), "rejected"
    )


def op9_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, sf, "labels")), keep=["doc_id"])
    return scored.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"), "offending",
    )


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    scored = quality_model.classify(table(spark, sf, "documents"), table(spark, sf, "labels"), where=fold(F.col("doc_id")) != 1)
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), F.col("quality").alias("score"),
        (F.col("quality") >= 0.5).cast("int").alias("predicted"),
    )


def op11_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"))


def op12_html_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    found = html_text.extract(pages, html_text.fit(pages), keep=["page_id", "url"])
    return found.select("row.page_id", "row.url", "text", "n_chars")


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_token_counts": op2_token_counts,
    "op3_decontamination": op3_decontamination,
    "op4_suffix_array": op4_suffix_array,
    "op5_license_scan": op5_license_scan,
    "op6_dart_minhash": op6_dart_minhash,
    "op7_lz_fingerprint": op7_lz_fingerprint,
    "op8_language": op8_language,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_html_text": op12_html_text,
    "op13_vector_codes": op13_vector_codes,
}

def _codes_sql(rounds: int = 4) -> str:
    """Product quantisation in SQL: a round is a pair of tables."""
    steps = [
        """kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS x FROM kept, range(4) AS t(p)
), book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
  FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)
)"""
    ]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT vec_id, p, min([list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), e]) AS best
  FROM parts JOIN book{i} USING (p) GROUP BY vec_id, p
)""")
        if i < rounds:
            steps.append(f"""book{i + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{i} b LEFT JOIN (
    SELECT p, e, list(mean ORDER BY j) AS c FROM (
      SELECT p, best[2] AS e, j, floor(sum(x[j]) / count(*)) AS mean
      FROM near{i} JOIN parts USING (vec_id, p), generate_series(1, len(x)) AS t(j) GROUP BY ALL
    ) GROUP BY p, e
  ) m USING (p, e)
)""")
    return f"""WITH {", ".join(steps)}, coded AS (
  SELECT vec_id, string_agg(lower(printf('%02X', best[2]::INT)), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error
  FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


ORACLE = {
    "op1_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), sources AS (
  SELECT source, sum(size)::DOUBLE AS source_size,
         [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) * 1.5 - coalesce(sum(2 * source_size) OVER w, 0))
            / ((SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER w, 0)) AS level
  FROM sources
  WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(2 * source_size, weight * (SELECT max(level) FROM levels)) AS target,
         ('0x' || substr(md5('0:' || coalesce('=' || source, '')), 1, 5))::BIGINT AS start
  FROM levels
), placed AS (
  SELECT doc_id, size, source_size::BIGINT AS source_size, target, start,
         CASE WHEN source_size > 0 THEN floor(target / source_size * 1048576)::BIGINT ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id) AS position
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       ((start + position * rate) // 1048576 - (start + (position - 1) * rate) // 1048576) * size AS taken
FROM placed""",
    "op11_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang
), counts AS MATERIALIZED (
  SELECT lang, size, phrase, count(*) AS f
  FROM (SELECT lang, size, unnest(list_transform(generate_series(1, len(w) - size + 1), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
        FROM words, generate_series(1, 5) AS s(size))
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[:k], ' ') AS head, array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') AS tail
  FROM counts, generate_series(1, 4) AS s(k) WHERE k < size
), scored AS (
  SELECT c.lang, c.phrase, a, h.f AS l, t.f AS r, n, k, ((1000::HUGEINT * a * n) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = head JOIN counts t ON t.lang = c.lang AND t.phrase = tail JOIN totals s ON s.lang = c.lang
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM lowest p WHERE NOT EXISTS (
    SELECT 1 FROM counts q WHERE q.lang = p.lang AND q.f >= p.a AND q.phrase <> p.phrase AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000""",
    "op13_vector_codes": _codes_sql(),
}
