"""The operators as queries over whole tables, and SQL to check those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.llm.base import read


def vocabulary() -> tuple[dict[bytes, int], str]:
    import public_tokenizers

    from logsieve.llm.bpe import read_ranks

    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as token ids and back."""
    from logsieve.llm.bpe import decode, encode

    ranks, pattern = vocabulary()
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs, ranks, pattern).select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        "n_split",
    )
    return decode(encoded, ranks, pattern).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "n_split"
    )


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which words of each document stand in a window of a test item."""
    from logsieve.llm.decontam import find_contamination

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, read(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(F.col("items").cast("array<string>")), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every text under a class-based model of six sevenths of them."""
    from logsieve.llm.brown import score_texts

    return score_texts(read(spark, sf_dir, "documents"), folds=7, held=2)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    from logsieve.llm.secrets import find_secrets

    found = find_secrets(read(spark, sf_dir, "documents")).withColumn("base", F.expr("filter(spans, s -> s.kind <> 'model')"))
    joined = lambda spans: F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")
    counts = [
        F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS bigint) AS n_{k}") for k in ("assign", "access", "hex")
    ]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    from logsieve.llm.pii import KINDS, find_pii

    docs = read(spark, sf_dir, "documents")
    found = find_pii(docs.select("doc_id", "text")).select("doc_id", "spans")
    joined = lambda spans: F.expr(f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')")
    base = found.withColumn("base", F.expr("filter(spans, s -> s.base)"))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{k}')) AS bigint) AS n_{k}") for k in KINDS]
    return base.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op6_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from two thirds of the labels."""
    from logsieve.llm.fourier import score_quality

    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), folds=3, held=1)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as an archive and read back."""
    from logsieve.llm.warc import read_back, write_archive

    return read_back(write_archive(read(spark, sf_dir, "pages"), least=0))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents the quality rules keep, and why not."""
    from logsieve.llm.quality_rules import quality_rules

    ruled = quality_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return ruled.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_failed_lines",
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 24 shards of near equal bytes."""
    from logsieve.llm.kdshards import kd_shards

    return kd_shards(read(spark, sf_dir, "documents"), shards=24).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets are at least 0.85 similar."""
    from logsieve.llm.hyperminhash import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"), percent=85)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2,048 ids."""
    import public_tokenizers

    from logsieve.llm.packing import pack, read_spec

    spec = read_spec(public_tokenizers.path("word_bpe_49k.json"))
    pieces = pack(read(spark, sf_dir, "documents"), spec, end=1, length=2048)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the best positives of every fiftieth vector."""
    from logsieve.llm.negatives import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(
        read(spark, sf_dir, "embeddings"),
        row_id=F.col("vec_id"),
        label=label,
        vector=F.col("embedding"),
        anchor=F.col("id") % 50 == 0,
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations by their common first turns."""
    from logsieve.llm.prefixtrie import conversation_trie

    return conversation_trie(read(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_lm_scores": op3_lm_scores,
    "op4_secrets": op4_secrets,
    "op5_personal_data": op5_personal_data,
    "op6_quality_scores": op6_quality_scores,
    "op7_warc": op7_warc,
    "op8_quality_rules": op8_quality_rules,
    "op9_sharding": op9_sharding,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_packing": op11_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_conversation_trie": op13_conversation_trie,
}

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTER_WORDS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_OP1_SQL = f"""
WITH item AS (SELECT item_id, {_LETTER_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n,
        unnest(list_transform(range(greatest(len(w) - 9, 1)), lambda i: list_aggregate(w[i + 1 : i + least(len(w), 10)], 'string_agg', ' '))) AS win
    FROM item WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM windows),
doc AS (SELECT doc_id, {_LETTER_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, n, unnest(range(greatest(len(w) - n + 1, 0))) AS i FROM doc, lengths),
met AS (
    SELECT doc_id, item_id, i, p.n FROM places p JOIN windows v
    ON v.n = p.n AND v.win = list_aggregate(p.w[i + 1 : i + p.n], 'string_agg', ' ')),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM met) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

# Five hexadecimal digits are four of base 32.
_QUAD = "(list_sum(list_transform(range(5), lambda k: (strpos('0123456789abcdef', substr(hex, 5 * g + k + 1, 1)) - 1) * (1 << (16 - 4 * k))))::BIGINT)"
_BASE32 = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({} >> {}) & 31)::INT, 1)"
_OP7_SQL = f"""
WITH page AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex FROM pages),
firsts AS (SELECT h, min(page_id) AS first FROM page GROUP BY h)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(8), lambda g: {" || ".join(_BASE32.format(_QUAD, k) for k in (15, 10, 5, 0))}), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM page JOIN firsts USING (h)"""

_WORDS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+')"
_OP10_SQL = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
shingle AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(len(w) - 4, 1)), lambda i: list_aggregate(w[i + 1 : i + 5], 'string_agg', ' '))) AS s
    FROM doc WHERE len(w) > 0),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id
    GROUP BY ALL),
link AS MATERIALIZED (
    SELECT x, y FROM common c JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
    WHERE 100 * c.n >= 85 * (a.n + b.n - c.n)),
both_ways AS MATERIALIZED (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM doc UNION SELECT r.doc_id, l.y FROM reach r JOIN both_ways l ON l.x = r.other),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN size USING (doc_id)"""

_PLAIN_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"
_OP8_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
word AS (SELECT r, doc_id, t, {_PLAIN_WORDS.format("t")} AS w FROM doc),
line AS (
    SELECT r, l, {_PLAIN_WORDS.format("l")} AS w, len(regexp_extract_all(l, '[#*$%&|<>]')) AS symbols, nr
    FROM (SELECT r, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS nr FROM doc)
    WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
judged AS (
    SELECT r, l, nr, length(array_to_string(w, '')) AS chars, symbols,
        len(w) <= 30 AND regexp_matches(l, '(?i)(all rights reserved|licensed under the)') AS notice,
        symbols * 100 >= length(l) * 12
        OR (len(w) >= 3 AND 100 * len(list_filter(w, lambda x: x IN ('|', '»', '«', '>', '>>', '/', '•', '·', '::', '–', '—'))) >= 25 * len(w))
        OR (len(w) <= 30 AND regexp_matches(l, '(?i)(all rights reserved|accept cookies|click here|cookie policy|enable javascript|licensed under the|log in to|privacy policy|read more|share this|sign up for|subscribe to|terms of service|terms of use)'))
        OR (len(w) >= 3 AND NOT regexp_matches(l, '\\p{{Ll}}') AND regexp_matches(l, '\\p{{Lu}}'))
        OR (len(w) >= 12 AND NOT regexp_matches(l, '[.,;:!?…。，、]')) AS fails,
        row_number() OVER (PARTITION BY r, l ORDER BY nr) AS nth
    FROM line),
lines AS (
    SELECT r, sum(symbols) AS symbols, count(*) - count(DISTINCT l) AS dups, count_if(fails) AS n_failed,
        coalesce(sum(chars) FILTER (NOT fails AND nth = 1), 0) AS solid, coalesce(sum(chars) FILTER (notice), 0) AS notices
    FROM judged GROUP BY r),
place AS (SELECT r, i, array_to_string(w[i + 1 : i + 5], ' ') AS win FROM (SELECT r, w, unnest(range(greatest(len(w) - 4, 0))) AS i FROM word)),
again AS (SELECT r, i FROM place QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS k FROM again) GROUP BY r),
counted AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, coalesce(symbols, 0) AS n_symbols,
        coalesce(dups, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, coalesce(n_failed, 0) AS n_failed_lines,
        coalesce(solid, 0) AS solid, coalesce(notices, 0) AS notices,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS stutter
    FROM word LEFT JOIN lines USING (r) LEFT JOIN covered c USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
    n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
        AND (n_failed_lines + n_dup_lines = 0 OR 100 * (word_chars - solid - notices) <= 50 * word_chars)
        AND 100 * stutter <= 30 * n_words AS kept,
    CAST(n_failed_lines AS BIGINT) AS n_failed_lines
FROM counted"""

_FINITE = "embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))"
_OP12_SQL = f"""
WITH labelled AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINITE}),
met AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
    FROM labelled a JOIN labelled b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positive AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM met WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positive JOIN met USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER best <= 3"""

# CRC-32, a byte at a time and a bit at a time; 3988292384 is its polynomial.
_CRC_BYTE = "list_reduce(list_prepend(xor(c, b), range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)"
_CRC32 = f"xor(list_reduce(list_prepend(4294967295, list_transform(range(len(s)), lambda i: CAST(ord(s[i + 1]) AS BIGINT))), lambda c, b: {_CRC_BYTE}), 4294967295)"
_OP13_SQL = f"""
WITH turn AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
keyed AS (
    SELECT conv_id, turn, substr(sha256(octet_length(encode(role)) || ':' || role || text), 1, 32) AS key, octet_length(encode(text)) AS size
    FROM turn),
conv AS (SELECT conv_id, CAST(conv_id AS VARCHAR) AS s, list(struct_pack(k := key, z := size) ORDER BY turn NULLS FIRST, key) AS own FROM keyed GROUP BY conv_id),
headed AS (SELECT conv_id, own, {_CRC32} % 9 AS h FROM conv),
whole AS (
    SELECT c.conv_id, list_concat(coalesce(b.own, [])[1 : c.h], c.own[c.h + 1 :]) AS turns
    FROM headed c LEFT JOIN headed b ON b.conv_id = c.conv_id - c.conv_id % 5),
member AS (SELECT conv_id, len(turns) AS n, turns, unnest(range(len(turns) + 1)) AS depth FROM whole),
path AS (
    SELECT conv_id, depth, depth = n AS ended, array_to_string(list_transform(turns[1 : depth], lambda t: t.k), '') AS node,
        CASE WHEN depth > 0 THEN array_to_string(list_transform(turns[1 : depth - 1], lambda t: t.k), '') END AS parent,
        CASE WHEN depth > 0 THEN turns[depth].z ELSE 0 END AS size FROM member),
node AS (
    SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, any_value(size) AS size, count(*) AS n, min(conv_id) AS least,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ended), '')) AS ends
    FROM path GROUP BY node),
kids AS (SELECT parent, count(*) AS n FROM node GROUP BY parent),
below AS (
    SELECT substr(a.node, 1, 32 * up) AS node, sum((a.n - 1) * a.size) AS saved, count_if(k.n IS NULL) AS leaves
    FROM (SELECT *, unnest(range(depth + 1)) AS up FROM node) a LEFT JOIN kids k ON k.parent = a.node GROUP BY 1)
SELECT a.least AS conv_id, CAST(a.depth AS BIGINT) AS depth, p.least AS parent_conv_id, CAST(a.n AS BIGINT) AS n_convs,
    CAST(coalesce(k.n, 0) AS BIGINT) AS n_children, CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
    a.ends AS ends_sha256
FROM node a JOIN below b ON a.node = b.node LEFT JOIN kids k ON k.parent = a.node LEFT JOIN node p ON p.node = a.parent"""

# The others learn a model or need tokenizers: tests hold them against brute force, exact round trips and
# held-out accuracy.
ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": _OP1_SQL,
    "op7_warc": _OP7_SQL,
    "op8_quality_rules": _OP8_SQL,
    "op10_near_duplicates": _OP10_SQL,
    "op12_hard_negatives": _OP12_SQL,
    "op13_conversation_trie": _OP13_SQL,
}
