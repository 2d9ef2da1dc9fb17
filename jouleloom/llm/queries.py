"""The corpus operators over the driver's tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jouleloom.llm import decontam, filteraudit, htmltext, idfiles, langid, linededup, packing, quality, resample, sharding, simhash, tokens, warc
from jouleloom.session import new_folder

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


@query
def op1_jump_sharding(spark: SparkSession, sf: str) -> DataFrame:
    whole = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf, "documents").select(
        "doc_id", (F.octet_length(whole) + 16).cast("bigint").alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32")
    )
    slots = sharding.shard_slots(docs, ["doc_id"], ["doc_id", "size", "text_crc32"], 40)
    grown = sharding.assign_shards(slots, ["doc_id"], 41, "grown_shard")
    return grown.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


#: The CRC is that of the bytes one by one, from a table made by its rule.
ORACLES["op1_jump_sharding"] = """
WITH RECURSIVE crc_steps(byte, n, value) AS (
    SELECT i, 0, i::BIGINT FROM range(256) t(i)
    UNION ALL
    SELECT byte, n + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END FROM crc_steps WHERE n < 8
),
crc_table AS (SELECT list(value ORDER BY byte) AS entries FROM crc_steps WHERE n = 8),
docs AS (
    SELECT row_number() OVER () AS r, doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size,
           ('0x' || left(md5(coalesce('=' || doc_id, 'null')), 16))::UBIGINT::HUGEINT AS key,
           xor(list_reduce(
               list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
               lambda a, x: xor(a >> 8, entries[(xor(a, x) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32
    FROM documents, crc_table
),
jumps(r, shards, key, here, there) AS (
    SELECT r, n, key, -1::BIGINT, 0::BIGINT FROM docs, (VALUES (40), (41)) s(n)
    UNION ALL
    SELECT r, shards, next, there, floor((there + 1) * (2147483648.0::DOUBLE / ((next // 8589934592)::DOUBLE + 1)))::BIGINT
    FROM (SELECT *, (key * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM jumps WHERE there < shards)
),
landed AS (
    SELECT r, max(here) FILTER (shards = 40)::INT AS shard, max(here) FILTER (shards = 41)::INT AS grown_shard
    FROM jumps GROUP BY r
),
placed AS (
    SELECT *, ('0x' || right(md5(concat(coalesce('=' || doc_id, 'null'), chr(31), '=' || size, chr(31), '=' || text_crc32)), 8))::BIGINT AS spread
    FROM docs JOIN landed USING (r)
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY spread, doc_id, size, text_crc32) - 1 AS slot, grown_shard
FROM placed
"""


@query
def op2_perplexity_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.quality(table(spark, sf, "documents"), keep=["doc_id"])
    return judged.select("doc_id", "quality.*")


@query
def op3_benchmark_leaks(spark: SparkSession, sf: str) -> DataFrame:
    found = decontam.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "n_words", "score", "start", "stop")


@query
def op4_harmonic_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack(table(spark, sf, "documents"), vocabulary(), capacity=1024, end_id=0)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf, "documents"), vocabulary(), limit=512)


@query
def op5_line_runs(spark: SparkSession, sf: str) -> DataFrame:
    kept = linededup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"), min_chars=100)
    return kept.select("doc_id", "n_lines", "n_deleted", "text")


ORACLES["op5_line_runs"] = """
WITH lines AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
           unnest(range(len(string_split(text, chr(10))))) AS n
    FROM documents WHERE text IS NOT NULL
),
twice AS (
    SELECT *, count(*) OVER (PARTITION BY line) AS times FROM lines
),
pairs AS (
    SELECT a.doc_id, a.n, b.doc_id AS other, b.n AS m, length(a.line) AS chars,
           a.n - row_number() OVER (PARTITION BY a.doc_id, b.doc_id, a.n - b.n ORDER BY a.n) AS island
    FROM twice a JOIN twice b ON a.line = b.line AND a.times > 1 AND b.times > 1
    WHERE b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.n < a.n)
),
runs AS (
    SELECT doc_id, min(n) AS first_line, max(n) AS last_line FROM pairs
    GROUP BY doc_id, other, n - m, island HAVING sum(chars) >= 100
),
marked AS (
    SELECT l.doc_id, l.n, l.line,
           EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = l.doc_id AND l.n BETWEEN r.first_line AND r.last_line) AS gone
    FROM lines l
),
kept AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted,
           coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '') AS text
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_deleted, 0) AS n_deleted, coalesce(k.text, d.text) AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


@query
def op7_warc_derivatives(spark: SparkSession, sf: str) -> DataFrame:
    """Pages come without a date of their capture, so the responses made of them carry a fixed one."""
    pages = table(spark, sf, "pages")
    responses = pages.select("page_id", "url", warc.response_record(F.col("url"), F.col("html"), "2024-01-01T00:00:00Z").alias("record"))
    derived = warc.derivatives(responses, keep=("page_id", "url"))
    return derived.withColumn("source_headers", F.to_json("source_headers"))


@query
def op8_byte_cnn(spark: SparkSession, sf: str) -> DataFrame:
    """A null doc_id counts as empty text, whose remainder is 0: such documents are held out."""
    docs = table(spark, sf, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    net = langid.train(docs.where(~held_out))
    return langid.identify_language(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op9_tag_path_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return htmltext.extract_text(table(spark, sf, "pages"))


@query
def op10_simhash_components(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"), size=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), simhash.hexadecimal("fingerprint").alias("fingerprint"), F.col("component").alias("component_id"))


@query
def op11_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    found = resample.importance_resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"), percent=25, min_words=20, seed=7, size=2, buckets=10000)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


#: Counts per bucket come from the features' texts; the CRC is that of the bytes one by one, as above.
ORACLES["op11_importance_resampling"] = """
WITH RECURSIVE crc_steps(byte, n, value) AS (
    SELECT i, 0, i::BIGINT FROM range(256) t(i)
    UNION ALL
    SELECT byte, n + 1, CASE WHEN value & 1 = 1 THEN xor(value >> 1, 3988292384) ELSE value >> 1 END FROM crc_steps WHERE n < 8
),
crc_table AS (SELECT list(value ORDER BY byte) AS entries FROM crc_steps WHERE n = 8),
texts AS (
    SELECT 'source' AS side, row_number() OVER () AS r, doc_id, text FROM documents
    UNION ALL SELECT 'target', row_number() OVER (), NULL, text FROM benchmark
),
cut AS (
    SELECT side, r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM texts
),
features AS (
    SELECT side, r, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature FROM cut
),
counted AS (SELECT side, r, feature, count(*) AS n FROM features GROUP BY ALL),
hashed AS (
    SELECT feature, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(feature)), '..'), lambda x: ('0x' || x)::BIGINT)),
        lambda a, x: xor(a >> 8, entries[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) % 10000 AS bucket
    FROM (SELECT DISTINCT feature FROM counted), crc_table
),
sums AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 'source'), 0) AS s, coalesce(sum(n) FILTER (side = 'target'), 0) AS t
    FROM counted JOIN hashed USING (feature) GROUP BY bucket
),
totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM sums),
gains AS (
    SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE)))::BIGINT AS gain
    FROM sums, totals
),
weights AS (
    SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight
    FROM counted JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 'source' GROUP BY r
),
scored AS (
    SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
    FROM cut LEFT JOIN weights USING (r) WHERE side = 'source'
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= 20 AND place <= (SELECT count(*) * 25 // 100 FROM scored WHERE n_words >= 20) THEN place END AS rank
FROM placed
"""


@query
def op12_id_files(spark: SparkSession, sf: str) -> DataFrame:
    """The ids are written and read back; what comes out is made of the files alone."""
    folder = new_folder(spark, "id-files")
    idfiles.write_ids(table(spark, sf, "documents"), vocabulary("word_bpe_49k.json"), folder, end_id=2)
    found = idfiles.document_digests(idfiles.read_digests(spark, folder))
    return found.withColumnRenamed("id", "doc_id")


@query
def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filteraudit.filter_audit(table(spark, sf, "documents"), table(spark, sf, "labels"), part="lang")


ORACLES["op13_filter_audit"] = """
WITH RECURSIVE known AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
),
docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
),
judged AS (
    SELECT d.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
        'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
        'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text), 'D': regexp_matches(text, '[#$%&*|]'),
        'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)} AS fails
    FROM docs d LEFT JOIN known k ON k.doc_id = d.doc_id
),
rows_of AS (
    SELECT part, good, toxic, [x.f for x in [{'f': 'A', 'b': fails.A}, {'f': 'B', 'b': fails.B}, {'f': 'C', 'b': fails.C}, {'f': 'D', 'b': fails.D}, {'f': 'E', 'b': fails.E}] if x.b] AS failed
    FROM judged
),
sets AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM rows_of GROUP BY ALL),
orders(filter_order) AS (
    SELECT '' UNION ALL
    SELECT filter_order || f FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(f) WHERE NOT contains(filter_order, f)
),
steps AS (
    SELECT part, filter_order, step, filter_order[step] AS f
    FROM orders, range(1, 6) s(step), (SELECT DISTINCT part FROM sets) WHERE length(filter_order) = 5
),
removal AS (
    SELECT part, filter_order, failed, n, good, toxic, list_min(list_transform(failed, lambda f: instr(filter_order, f))) AS at
    FROM sets, orders WHERE length(filter_order) = 5
),
sums AS (
    SELECT s.part, s.filter_order, s.step::INT AS step, any_value(s.f) AS f,
           coalesce(sum(r.n) FILTER (r.at IS NULL OR r.at > s.step), 0)::BIGINT AS kept,
           coalesce(sum(r.n) FILTER (r.at = s.step), 0)::BIGINT AS removed,
           coalesce(sum(r.n) FILTER (r.at < s.step AND list_contains(r.failed, s.f)), 0)::BIGINT AS redundant,
           coalesce(sum(r.n) FILTER (r.failed = [s.f]), 0)::BIGINT AS unique_fails,
           coalesce(sum(r.good) FILTER (r.at = s.step), 0)::BIGINT AS good_lost,
           coalesce(sum(r.toxic) FILTER (r.at = s.step), 0)::BIGINT AS toxic_lost
    FROM steps s JOIN removal r ON r.part = s.part AND r.filter_order = s.filter_order GROUP BY ALL
)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM sums
"""
