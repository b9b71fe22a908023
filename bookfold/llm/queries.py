"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookfold.llm import (
    bpe,
    html_content,
    line_dedup,
    ngram_join,
    packing,
    quality,
    shard_tree,
    spelling,
    substring_dedup,
    token_alignment,
    token_files,
    topk,
    url_filter,
)
from bookfold.llm.common import read_table
from bookfold.llm.stages import LINE_MIN_PAGES, LINE_RATIO
from bookfold.session import shared_folder

#: End-of-document id of the token files.
END_ID = 2


#: 16 shards: two regions of two racks of four. The grown tree has one more, in a rack that is there.
SHARDS = shard_tree.ShardTree.uniform(regions=2, racks=2, shards=4)
GROWN_SHARDS = SHARDS.with_shard(region=1, rack=3)
#: Least code points of a word that takes part in spelling groups.
WORD_LENGTH = 7


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(read_table(spark, sf_dir, "pages"), [*url_filter.PATH_RULES, *url_filter.BLOCK_LIST])
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    model = html_content.train_content_model(html_content.labelled_pages(pages))
    return html_content.extract_main_text(pages, model).withColumn("n_chars", F.length("text").cast("long"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-files")
    token_files.write_token_files(read_table(spark, sf_dir, "documents"), path, vocabulary_path(), END_ID)
    read = token_files.read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    trees = quality.train_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.judge_quality(docs, trees).drop("probability")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    cleaned = line_dedup.drop_boilerplate_lines(docs, LINE_RATIO, LINE_MIN_PAGES, dropped="n_dropped")
    return cleaned.select("doc_id", F.col("n_dropped").cast("long").alias("n_dropped"), "text")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(read_table(spark, sf_dir, "documents"), vocabulary_path())
    decimal = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "shards")
    shard_tree.write_shards(read_table(spark, sf_dir, "documents"), SHARDS, path)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return shard_tree.read_shards(spark, path).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_tree.shard_of(GROWN_SHARDS, "doc_id").alias("grown_shard"),
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.counted_words(read_table(spark, sf_dir, "documents"), WORD_LENGTH)
    return spelling.grouped_variants(words, least_length=WORD_LENGTH)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "alignment")
    docs = read_table(spark, sf_dir, "documents")
    token_alignment.write_alignment(docs, path, vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))
    return token_alignment.aligned_documents(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_url_filter": op2_url_filter,
    "op3_packing": op3_packing,
    "op4_html_extraction": op4_html_extraction,
    "op5_token_files": op5_token_files,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_top_k": op8_top_k,
    "op9_line_dedup": op9_line_dedup,
    "op10_bpe": op10_bpe,
    "op11_sharding": op11_sharding,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_alignment": op13_token_alignment,
}

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TRIMMED = r"regexp_replace({}, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"

#: The 256 remainders of CRC-32 as a list ``t`` in the one row of ``crc_table``.
_CRC_TABLE = """WITH RECURSIVE crc_steps AS (
        SELECT range AS i, range AS c, 0 AS k FROM range(256)
        UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8
    ), crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_steps WHERE k = 8)"""
_CRC = (
    "CAST(xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode({})), '..'), lambda p: CAST('0x' || p AS BIGINT))), "
    "lambda c, b: xor(c >> 8, t[CAST(xor(c & 255, b) AS INTEGER) + 1])), 4294967295) AS BIGINT)"
)


def _sql_shard(tree: shard_tree.ShardTree, name: str) -> str:
    """CTEs that lead each doc_id down the tree: ``name`` has doc_id and shard."""
    edges = ", ".join(f"({level}, '{parent}', '{child}', {weight})" for level in (1, 2, 3) for parent, held in tree.children(level).items() for child, weight in held)
    draw = "-ln((CAST('0x' || substr(md5(doc_id || ' ' || child), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0::DOUBLE) / weight"
    steps = [f"{name}_edges(level, parent, child, weight) AS (VALUES {edges}), {name}_0 AS (SELECT DISTINCT doc_id, '' AS node FROM documents)"]
    for level in (1, 2, 3):
        steps.append(f"{name}_{level} AS (SELECT doc_id, arg_min(child, {draw}) AS node FROM {name}_{level - 1} JOIN {name}_edges ON level = {level} AND parent = node GROUP BY doc_id)")
    steps.append(f"{name} AS (SELECT doc_id, CAST(regexp_extract(node, '([0-9]+)$', 1) AS INTEGER) AS shard FROM {name}_3)")
    return ", ".join(steps)


ORACLE: dict[str, str] = {
    "op2_url_filter": rf"""
        WITH cut AS (
            SELECT page_id,
                translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), {_AZ}) AS host,
                coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), ruled AS (
            SELECT *, CASE
                WHEN regexp_matches(host, '^(.*\.)?example\.net$') AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN regexp_matches(host, '^(.*\.)?example\.com$') AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN regexp_matches(host, '^(.*\.)?org$') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN regexp_matches(host, '^(.*\.)?net$') AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM cut
        )
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN host <> '' AND (regexp_matches(host || path, '^([^/]*\.)?(cheap-pills|casino-win|free-bets|spam-farm|ads-track)\.')
                OR regexp_matches(host || path, '^([^/]*[^a-z0-9/])?(adult|xxx|porn|casino|pills|bets|spam|doubleclick)([^a-z0-9]|$)')) THEN 'block'
            ELSE 'allow' END AS verdict
        FROM ruled""",
    "op9_line_dedup": rf"""
        WITH split_lines AS (
            SELECT doc_id, source, text, line, place, {_TRIMMED.format('line')} AS bare
            FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS t(line, place)
        ), totals AS (SELECT source, count(*) AS total FROM documents GROUP BY source
        ), frequent AS (
            SELECT source, bare FROM (SELECT source, bare, count(DISTINCT doc_id) AS pages FROM split_lines WHERE bare <> '' GROUP BY source, bare)
            JOIN totals USING (source) WHERE pages >= {LINE_MIN_PAGES} AND pages > {LINE_RATIO} * total
        ), marked AS (
            SELECT s.*, f.bare IS NOT NULL AS dropped FROM split_lines s LEFT JOIN frequent f ON s.source = f.source AND s.bare = f.bare
        )
        SELECT doc_id, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
            coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '') AS text
        FROM marked GROUP BY doc_id""",
    "op11_sharding": f"""
        {_CRC_TABLE}, {_sql_shard(SHARDS, 'placed')}, {_sql_shard(GROWN_SHARDS, 'grown')}
        SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size, {_CRC.format("coalesce(text, '')")} AS text_crc32, 'key' AS law,
            placed.shard, CAST(row_number() OVER (PARTITION BY placed.shard ORDER BY doc_id) - 1 AS BIGINT) AS slot, grown.shard AS grown_shard
        FROM documents JOIN placed USING (doc_id) JOIN grown USING (doc_id), crc_table""",
    "op12_spelling_variants": f"""
        {_CRC_TABLE}, runs AS (
            SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), {_AZ}) AS run FROM documents
        ), hashed AS (
            SELECT run, n, {_CRC.format("doc_id || ':' || run")} AS h FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL), crc_table
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n
            FROM (SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
            WHERE length(word) >= {WORD_LENGTH} GROUP BY word HAVING sum(n) >= 2
        ), cut AS (
            SELECT word, n, spot, substr(word, 1, spot) || substr(word, spot + 2) AS rest FROM words, unnest(range(length(word))) AS places(spot)
        ), near AS (
            SELECT cut.word, cut.rest AS other, w.n AS other_n FROM cut JOIN words w ON w.word = cut.rest
            UNION SELECT w.word, cut.word, cut.n FROM cut JOIN words w ON w.word = cut.rest
            UNION SELECT x.word, y.word, y.n FROM cut x JOIN cut y ON x.rest = y.rest AND x.spot = y.spot AND x.word <> y.word
        ), best AS (
            SELECT word, count(*) AS n_near, min((-other_n, other)) AS lead FROM near GROUP BY word
        ), formed AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -lead[1] >= 10 * n THEN lead[2] END AS form, CASE WHEN -lead[1] >= 10 * n THEN -lead[1] END AS form_n
            FROM words LEFT JOIN best USING (word)
        ), walked AS (
            SELECT word, word AS root FROM formed
            UNION ALL SELECT walked.word, formed.form FROM walked JOIN formed ON formed.word = walked.root WHERE formed.form IS NOT NULL
        )
        SELECT formed.word, n, CAST(n_near AS BIGINT) AS n_near, form, CAST(form_n AS BIGINT) AS form_n, root
        FROM formed JOIN (SELECT w.word, w.root FROM walked w JOIN formed f ON f.word = w.root WHERE f.form IS NULL) USING (word)""",
}
