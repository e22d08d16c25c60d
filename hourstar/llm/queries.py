"""The operators as queries on the test tables, with the SQL that equals them where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourstar.llm import bpe, decontaminate, html_extract, lexical, pii, sharding, simhash, spelling, token_count, topk, toxicity, url_filter, warc
from hourstar.llm.shared import send_package
from hourstar.session import literal_table, scratch_path

SHARDS = 40
WORD_FILE, BYTE_FILE = "word_bpe_49k.json", "byte_bpe_50k.json"
TOKEN_LIMIT = 512
TOP = 10
TOP_DOCUMENTS = 20

# The rules that op4 judges by.
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    send_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> bytes:
    """A public tokenizer's file, read on the driver: 1.7 MB that go out with the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def encoded(docs: DataFrame) -> DataFrame:
    done = bpe.encode_and_decode(docs, tokenizer_file(WORD_FILE))
    return done.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, TOP)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_count.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_file(BYTE_FILE))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select("*", F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = literal_table(spark, RULES, {"rule": "STRING", "verdict": "STRING"})
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules, keep=["page_id"])


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    records, _ = warc.read_archives(spark, path, payloads=False, strict=True)
    return records.select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), TOP_DOCUMENTS)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(_table(spark, sf_dir, "documents"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    return found.select("doc_id", *[f"n_{kind}" for kind in pii.KINDS], F.sha2(pii.as_text("base"), 256).alias("base_sha256"), pii.as_text("spans").alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_bpe": op2_bpe,
    "op3_sharding": op3_sharding,
    "op4_url_filter": op4_url_filter,
    "op5_html_extraction": op5_html_extraction,
    "op6_decontamination": op6_decontamination,
    "op7_token_count": op7_token_count,
    "op8_warc": op8_warc,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_lexical_search": op11_lexical_search,
    "op12_spelling": op12_spelling,
    "op13_pii": op13_pii,
}

ORACLE: dict[str, str] = {
    "op1_top_k": """
        WITH parts AS (
            SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings
            WHERE vec_id IS NOT NULL
        ), bad AS (
            SELECT DISTINCT vec_id FROM parts WHERE x IS NULL OR NOT isfinite(x)
        ), v AS (
            SELECT vec_id, pos, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM parts
            WHERE vec_id NOT IN (SELECT vec_id FROM bad)
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id, CAST(sum(q.x * d.x) AS BIGINT) AS score
            FROM v q JOIN v d ON q.pos = d.pos AND q.vec_id <> d.vec_id
            WHERE q.vec_id % 100 = 0 GROUP BY 1, 2
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op6_decontamination": r"""
        WITH words AS (
            SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM documents
            UNION ALL SELECT 'i', item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') FROM benchmark
        ), shingles AS (
            SELECT DISTINCT kind, id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS shingle
            FROM words WHERE len(w) > 0
        ), sizes AS (
            SELECT id AS item_id, count(*) AS item_shingles FROM shingles WHERE kind = 'i' GROUP BY id
        ), shared AS (
            SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared FROM shingles d JOIN shingles i USING (shingle)
            WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY ALL
        )
        SELECT doc_id, item_id, shared, item_shingles, shared / item_shingles AS containment
        FROM shared JOIN sizes USING (item_id) WHERE 10 * shared >= 8 * item_shingles
    """,
    "op11_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
            FROM documents
        ), sized AS (
            SELECT row, doc_id, terms, len(terms) AS n FROM d WHERE len(terms) > 0
        ), total AS (
            SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sized
        ), tf AS (
            SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, n, unnest(terms) AS term FROM sized) GROUP BY ALL
        ), df AS (
            SELECT term, count(*) AS df FROM tf GROUP BY term
        ), asked AS (
            SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
                FROM benchmark) GROUP BY ALL
        ), scored AS (
            SELECT item_id, row, doc_id, CAST(sum(
                times * CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2 * df + 1))) AS BIGINT)
                * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // length)))) AS BIGINT) AS score
            FROM asked JOIN df USING (term) JOIN tf USING (term), total GROUP BY ALL
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
    "op4_url_filter": r"""
        WITH parts AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
            FROM pages
        ), split AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path
            FROM parts
        ), judged AS (
            SELECT page_id, host, path, CASE
                WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
            FROM split
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IS NULL OR rule IN ('com/', 'www.example.com/en/') THEN 'allow' ELSE 'block' END AS verdict
        FROM judged
    """,
}
