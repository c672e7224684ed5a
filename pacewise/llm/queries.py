"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import Registry
from pacewise.llm import (
    articles,
    bpe,
    chunks,
    codes,
    embeddings,
    leaks,
    mixing,
    ngrams,
    quality,
    ranked,
    shards,
    urls,
    warc,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.extract(table(spark, sf_dir, "pages"))


def tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def token_digests(encoded: DataFrame) -> DataFrame:
    """Per row of bpe.encode(): doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(bpe.encode(table(spark, sf_dir, "documents"), tokenizer()))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.similarity_links(table(spark, sf_dir, "embeddings"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(table(spark, sf_dir, "pages"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.exact_groups(table(spark, sf_dir, "documents"))


OP5 = """
WITH digests AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
    FROM documents),
classes AS (
    SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size
    FROM digests GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256
FROM digests JOIN classes USING (text_sha256)
"""


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.similarity_classes(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shards(table(spark, sf_dir, "documents"))


#: Every prefix of every hash with its size; the shortest that fits is the shard.
OP7 = """
WITH hashed AS (
    SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
           ('0x' || md5(doc_id::VARCHAR)[1:15])::BIGINT AS h
    FROM documents),
prefixes AS (
    SELECT doc_id, n_bytes, d, h >> (60 - d) AS p
    FROM hashed, (SELECT unnest(generate_series(0, 60)) AS d)),
sizes AS (
    SELECT d, p, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs
    FROM prefixes GROUP BY d, p),
fitting AS (
    SELECT doc_id, any_value(n_bytes) AS n_bytes, min(d) AS depth, arg_min(p, d) AS p,
           arg_min(shard_bytes, d) AS shard_bytes, arg_min(shard_docs, d) AS shard_docs
    FROM prefixes JOIN sizes USING (d, p)
    WHERE shard_bytes <= 1048576 OR shard_docs = 1
    GROUP BY doc_id)
SELECT doc_id, n_bytes, depth::INTEGER AS depth, shard_bytes, shard_docs,
       CASE WHEN depth = 0 THEN '' ELSE right(p::BIT::VARCHAR, depth::INTEGER) END AS shard
FROM fitting
"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


#: Sources filled in the order in which they are full; documents in the order of their hash.
OP9 = r"""
WITH sized AS (
    SELECT doc_id, source, md5(doc_id::VARCHAR) AS place,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE
               AS weight
    FROM sized GROUP BY source),
levels AS (
    SELECT *, 2.0::DOUBLE * source_size AS cap, 2.0::DOUBLE * source_size / weight AS full_at,
           (1.5::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum(2 * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight,
                source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight,
                source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM sources),
goals AS (
    SELECT *, least(cap, weight * (SELECT arg_min(level, full_at) FROM levels
                                   WHERE full_at > level)) AS target
    FROM levels),
rounds AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS full_rounds
    FROM goals),
placed AS (
    SELECT doc_id, size, source_size, target, full_rounds,
           target - full_rounds * source_size
           - (sum(size) OVER (PARTITION BY sized.source ORDER BY place) - size) AS room
    FROM sized JOIN rounds ON sized.source IS NOT DISTINCT FROM rounds.source)
SELECT doc_id, size, source_size, target,
       (size * (full_rounds + CASE WHEN room >= size OR (room > 0 AND 2 * room >= size)
                              THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


OP10 = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, url FROM pages),
digests AS (
    SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest, url
    FROM payloads),
copies AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM digests)
SELECT page_id, payload_bytes, payload_digest, url AS target_uri,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM copies
"""


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compressed(spark, table(spark, sf_dir, "embeddings"))


def _op11() -> str:
    """Rounds of assignment and replacement over components, one row each."""
    rounds = []
    for r in range(3):
        rounds.append(f"""
a{r} AS MATERIALIZED (
    SELECT row_no, p, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d
    FROM (SELECT row_no, p, e, coalesce(sum((x - c) * (x - c)), 0)::BIGINT AS d
          FROM component JOIN b{r} USING (p, k) GROUP BY ALL)
    GROUP BY row_no, p)""")
        if r < 2:
            rounds.append(f"""
s{r} AS (
    SELECT p, e, k, sum(x)::BIGINT AS s, count(*) AS n
    FROM component JOIN a{r} USING (row_no, p) GROUP BY ALL),
b{r + 1} AS MATERIALIZED (
    SELECT p, e, k, coalesce((s - ((s % n) + n) % n) // n, c) AS c
    FROM b{r} LEFT JOIN s{r} USING (p, e, k))""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row_no, vec_id, label, embedding,
           len(embedding) // 16 AS wide
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND (SELECT count(*) FROM unnest(embedding) AS u(x) WHERE x IS NULL OR NOT isfinite(x)) = 0),
component AS MATERIALIZED (
    SELECT row_no, (i - 1) // wide AS p, (i - 1) % wide AS k,
           floor(256 * embedding[i]::DOUBLE)::BIGINT AS x
    FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
b0 AS MATERIALIZED (SELECT p, row_no - 1 AS e, k, x AS c FROM component WHERE row_no <= 64),
{",".join(rounds)},
coded AS (
    SELECT row_no, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
    FROM a2 GROUP BY row_no),
books AS (
    SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, k)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error,
       (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row_no), books
"""


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.best_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""
WITH cut AS (
    SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all({LOWERED},
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
long AS (SELECT row_no, doc_id, len(terms) AS size FROM cut WHERE len(terms) > 0),
total AS (SELECT count(*) AS n_docs, sum(size)::BIGINT AS n_terms FROM long),
frequency AS (
    SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM cut)
    GROUP BY ALL),
held AS (SELECT term, count(*) AS df FROM frequency GROUP BY term),
asked AS (
    SELECT item_id, unnest(list_distinct(regexp_extract_all({LOWERED},
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
    FROM benchmark),
points AS (
    SELECT item_id, row_no, doc_id,
           sum(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
               * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n_docs) // n_terms)))
              )::BIGINT AS score
    FROM asked JOIN frequency USING (term) JOIN held USING (term) JOIN long USING (row_no), total
    GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER
           AS "rank", doc_id, score
FROM points WHERE score > 0 QUALIFY "rank" <= 10
"""


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.scanned(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


#: Windows of each size that items have, against all places of documents.
OP13 = rf"""
WITH cut AS (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(regexp_extract_all({LOWERED},
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
    FROM documents),
items AS (
    SELECT item_id, words, least(len(words), 10) AS size
    FROM (SELECT item_id, regexp_extract_all({LOWERED},
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark)
    WHERE len(words) > 0),
windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS part
    FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM items)),
places AS (
    SELECT row_no, size, i, array_to_string(words[i:i + size - 1], ' ') AS part
    FROM (SELECT row_no, words, size, unnest(range(1, len(words) - size + 2)) AS i
          FROM cut, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
met AS (SELECT DISTINCT row_no, i, size, item_id FROM places JOIN windows USING (size, part)),
hit AS (
    SELECT row_no, count(DISTINCT place) AS n_hit
    FROM (SELECT row_no, unnest(range(i, i + size)) AS place FROM met) GROUP BY row_no),
named AS (
    SELECT row_no, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT row_no, item_id::VARCHAR AS name FROM met) GROUP BY row_no)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM cut LEFT JOIN hit USING (row_no) LEFT JOIN named USING (row_no)
"""


def add_to(registry: Registry) -> None:
    registry.add("op1_html_extraction", op1_html_extraction)
    registry.add("op2_bpe", op2_bpe)
    registry.add("op3_embedding_dedup", op3_embedding_dedup)
    registry.add("op4_url_filters", op4_url_filters)
    registry.add("op5_exact_dedup", op5_exact_dedup, OP5)
    registry.add("op6_ngram_join", op6_ngram_join)
    registry.add("op7_sharding", op7_sharding, OP7)
    registry.add("op8_quality", op8_quality)
    registry.add("op9_mixing", op9_mixing, OP9)
    registry.add("op10_warc", op10_warc, OP10)
    registry.add("op11_vector_codes", op11_vector_codes, _op11())
    registry.add("op12_ranked_search", op12_ranked_search, OP12)
    registry.add("op13_decontamination", op13_decontamination, OP13)
