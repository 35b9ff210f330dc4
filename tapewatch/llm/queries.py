"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapewatch.llm import byte_bpe, decontaminate, language, licenses, line_dedup, phrases, pii, quality, sharding
from tapewatch.llm import simhash, trie
from tapewatch.llm.exact_dedup import exact_duplicates
from tapewatch.llm.support import cut, new_folder, small_batches
from tapewatch.llm.token_files import read_token_files, with_starts, write_token_files

Query = Callable[[SparkSession, str], DataFrame]

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
#: For the query only: a deployment brings its own secret.
PSEUDONYM_KEY = b"key of the registered query"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, test item) with its alignment score."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated_pairs(documents(spark, sf_dir), benchmark)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that is kept of its group."""
    return exact_duplicates(documents(spark, sf_dir))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What licences every document names or contains."""
    scan = documents(spark, sf_dir).select("doc_id", licenses.scanned(F.col("text")).alias("scan"))
    return scan.select(
        "doc_id",
        "scan.n_words",
        "scan.n_base",
        "scan.first_word",
        "scan.last_word",
        F.array_join("scan.base_labels", ",").alias("base_labels"),
        F.array_join("scan.labels", ",").alias("labels"),
        "scan.score",
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and near-duplicate class."""
    return simhash.simhash_components(documents(spark, sf_dir))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that are boilerplate in its source."""
    kept = line_dedup.drop_boilerplate(
        documents(spark, sf_dir).select("doc_id", "source", "text"),
        kept_text="kept_text",
        counts=("n_lines", "n_dropped"),
    )
    return kept.select("doc_id", "source", "n_lines", "n_dropped", "kept_text")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot; row counts of shards are at most one apart."""
    return sharding.shard_rows(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return byte_bpe.with_tokens(docs, BYTE_RANKS, offsets=None, decoded="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; one without an id is neither trained on nor held out."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document, by a model of the documents not held out."""
    docs = documents(spark, sf_dir)
    out = held_out(F.col("doc_id"))
    model = language.train(docs.filter(F.col("doc_id").isNotNull() & ~out))
    found = docs.select(
        "doc_id", out.alias("held_out"), language.predicted(F.col("text"), model).alias("found")
    )
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as its token files have it, in a folder of this run."""
    folder = new_folder(spark, "op9-token-files")
    write_token_files(documents(spark, sf_dir), folder, WORD_TOKENIZER, END_ID)
    found = cut(read_token_files(spark, folder, with_ids=False).drop("ids"))
    return with_starts(found).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers, dates and addresses replaced."""
    found = documents(spark, sf_dir).select(
        "doc_id", pii.pseudonymised(F.col("text"), PSEUDONYM_KEY).alias("found")
    )
    return found.select(
        "doc_id",
        F.size("found.spans").cast("long").alias("n_spans"),
        F.array_join(F.array_sort(F.array_distinct("found.spans.kind")), ",").alias("kinds"),
        F.col("found.text").alias("text"),
    )


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return phrases.collocations(documents(spark, sf_dir))


#: From this probability of label 1 on, a document is predicted to have it.
GOOD = 0.7


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learnt from labels of documents not held out."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scores = quality.quality_scores(docs, labels, ~held_out(F.col("doc_id")))
    return scores.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


QUERIES: dict[str, Query] = {
    build.__name__: build
    for build in (
        op1_decontamination,
        op2_exact_dedup,
        op3_license_scan,
        op4_simhash,
        op5_line_dedup,
        op6_sharding,
        op7_byte_bpe,
        op8_language_id,
        op9_token_files,
        op10_pseudonyms,
        op11_conversation_trie,
        op12_collocations,
        op13_quality,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
            FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept,
               sha256(t) AS text_sha256
        FROM d
        WINDOW same AS (PARTITION BY t)
    """,
    "op5_line_dedup": f"""
        WITH d AS (
            SELECT doc_id, source, text, row_number() OVER () AS page,
                   coalesce(string_split(text, chr(10)), []) AS lines
            FROM documents
        ), l AS (
            SELECT DISTINCT page, source, line FROM (
                SELECT page, source, trim(unnest(lines), ' ' || chr(9) || chr(13)) AS line FROM d
            ) WHERE line <> ''
        ), totals AS (
            SELECT source, count(*) AS total FROM d GROUP BY source
        ), counted AS (
            SELECT source, line, count(*) AS pages FROM l GROUP BY source, line
        ), dropped AS (
            SELECT c.source, list(c.line) AS drops
            FROM counted c JOIN totals t ON c.source IS NOT DISTINCT FROM t.source
            WHERE c.pages >= {line_dedup.MIN_PAGES} AND c.pages > t.total * {line_dedup.MAX_SHARE}
            GROUP BY c.source
        ), kept AS (
            SELECT d.doc_id, d.source, d.text, d.lines,
                   list_filter(d.lines, lambda x:
                       NOT list_contains(coalesce(b.drops, []), trim(x, ' ' || chr(9) || chr(13)))) AS k
            FROM d LEFT JOIN dropped b ON d.source IS NOT DISTINCT FROM b.source
        )
        SELECT doc_id, source, len(lines) AS n_lines, len(lines) - len(k) AS n_dropped,
               CASE WHEN text IS NULL THEN NULL ELSE array_to_string(k, chr(10)) END AS kept_text
        FROM kept
    """,
    "op11_conversation_trie": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL
        ), own AS (
            SELECT conv_id, strlen(text) AS bytes, sha256(strlen(role) || ':' || role || text) AS id,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(strlen(role) || ':' || role || text)) AS pos
            FROM turns
        ), convs AS (
            SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base,
                   xor(list_reduce(
                       list_prepend(4294967295::BIGINT,
                           list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
                       lambda crc, code: list_reduce([xor(crc, code), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                           lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))
                   ), 4294967295::BIGINT) % 9 AS h
            FROM turns
        ), heads AS (
            SELECT c.conv_id, o.pos AS d, o.id, o.bytes
            FROM convs c JOIN own o ON o.conv_id = c.base AND o.pos <= c.h
        ), begun AS (
            SELECT conv_id, count(*) AS turns FROM heads GROUP BY conv_id
        ), rebuilt AS (
            SELECT * FROM heads
            UNION ALL
            SELECT c.conv_id, coalesce(b.turns, 0) + o.pos - c.h, o.id, o.bytes
            FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.pos > c.h
            LEFT JOIN begun b ON b.conv_id = c.conv_id
        ), sequences AS (
            SELECT conv_id, list(id ORDER BY d) AS ids FROM rebuilt GROUP BY conv_id
        ), members AS (
            SELECT r.conv_id, r.d, r.bytes, sha256(array_to_string(s.ids[1:r.d], '')) AS node
            FROM rebuilt r JOIN sequences s ON s.conv_id = r.conv_id
            UNION ALL
            SELECT conv_id, 0, 0, '' FROM convs
        ), lasts AS (
            SELECT conv_id, max(d) AS last FROM members GROUP BY conv_id
        ), nodes AS (
            SELECT m.d, m.node, min(m.conv_id) AS conv_id, count(*) AS n_convs, min(m.bytes) AS bytes,
                   coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (WHERE l.last = m.d), '') AS ends
            FROM members m JOIN lasts l ON l.conv_id = m.conv_id GROUP BY m.d, m.node
        ), linked AS (
            SELECT n.*, p.node AS parent
            FROM nodes n LEFT JOIN members p ON p.conv_id = n.conv_id AND p.d = n.d - 1
        ), children AS (
            SELECT d - 1 AS d, parent AS node, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL
        ), sums AS (
            SELECT a.d, a.node, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves,
                   sum((x.n_convs - 1) * x.bytes) AS saved
            FROM nodes x JOIN members a ON a.conv_id = x.conv_id AND a.d <= x.d
            LEFT JOIN children c ON c.d = x.d AND c.node = x.node
            GROUP BY a.d, a.node
        )
        SELECT x.conv_id, x.d::BIGINT AS depth, p.conv_id AS parent_conv_id, x.n_convs,
               coalesce(c.n, 0)::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves,
               s.saved::BIGINT AS saved_tokens, sha256(x.ends) AS ends_sha256
        FROM linked x
        LEFT JOIN nodes p ON p.d = x.d - 1 AND p.node = x.parent
        LEFT JOIN children c ON c.d = x.d AND c.node = x.node
        JOIN sums s ON s.d = x.d AND s.node = x.node
    """,
    "op12_collocations": f"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), split AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w
            FROM pieces
        ), phrases AS (
            SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2),
                       lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
            FROM split, (VALUES (1), (2), (3)) sizes(size)
        ), counts AS (
            SELECT lang, size, phrase, count(*)::HUGEINT AS n FROM phrases GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(n)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
        ), candidates AS (
            SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND n >= {phrases.MIN_COUNT}
        ), cuts AS (
            SELECT lang, phrase, size, n AS a, unnest(range(1, size)) AS k, w FROM candidates
        ), scored AS (
            SELECT c.lang, c.phrase, c.size, c.a, c.k, x.n AS l, y.n AS r, 1000000 * c.a * c.a // (x.n * y.n) AS score
            FROM cuts c
            JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
            JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1
        ), covering AS (
            SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(n) AS longest
            FROM candidates, (VALUES (1), (2)) starts(i) WHERE size = 3 GROUP BY ALL
        ), ranked AS (
            SELECT s.*, row_number() OVER (PARTITION BY s.lang
                       ORDER BY s.score DESC, s.a DESC, encode(s.phrase)) AS rank
            FROM scored s LEFT JOIN covering c ON c.lang = s.lang AND c.phrase = s.phrase
            WHERE c.longest IS NULL OR 100 * c.longest < {phrases.COVERED} * s.a
        )
        SELECT r.lang, r.rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, t.n,
               r.score::BIGINT AS score
        FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= {phrases.PER_LANGUAGE}
    """,
}
