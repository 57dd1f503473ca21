"""Registered queries of the text operators: each applies one to its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import alignment, bpe, decontaminate, licenses, line_dedup, packing, pii, preference, quality, simhash, toxicity, warc, whitening

TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    columns = ["doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"]
    return pieces.select(columns)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup(table(spark, sf_dir, "documents"))
    spans = F.transform("removed", lambda r: F.concat_ws(":", r["start"].cast("string"), r["end"].cast("string")))
    counts = ["n_units", "n_removed", "n_removed_words", "longest_run"]
    return kept.select("doc_id", *counts, F.array_join(spans, ",").alias("removed"), F.md5("text").alias("kept_md5"))


OP2_SQL = """
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, generate_subscripts(parts, 1) AS k, unnest(parts) AS part FROM parts),
norms AS (SELECT *, trim(regexp_replace(lower(part), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS norm,
          sum(length(part) + 1) OVER (PARTITION BY doc_id ORDER BY k) - length(part) - 1 AS pos FROM lines),
held AS (SELECT *, length(norm) - length(replace(norm, ' ', '')) + 1 AS words,
         row_number() OVER (PARTITION BY doc_id ORDER BY k) AS place FROM norms WHERE norm <> ''),
paragraphs AS (SELECT doc_id, min(k) AS first, max(k) AS last, string_agg(norm, ' ' ORDER BY k) AS norm
               FROM held GROUP BY doc_id, k - place HAVING count(*) > 1),
units AS (SELECT doc_id, k AS first, k AS last, norm FROM held UNION ALL SELECT * FROM paragraphs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, first) AS n FROM units),
gone AS (SELECT DISTINCT held.* FROM held JOIN ranked ON held.doc_id = ranked.doc_id AND k BETWEEN first AND last AND n > 1),
runs AS (SELECT doc_id, sum(words) AS words FROM (
         SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM gone) GROUP BY doc_id, run),
longest AS (SELECT doc_id, max(words) AS longest FROM runs GROUP BY doc_id),
whole AS (SELECT n.*, g.k IS NOT NULL AS out, coalesce(g.words, 0) AS words FROM norms n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.k = g.k)
SELECT doc_id, count(*) AS n_units, count(*) FILTER (out) AS n_removed, CAST(sum(words) AS BIGINT) AS n_removed_words,
       CAST(coalesce(any_value(longest), 0) AS BIGINT) AS longest_run,
       coalesce(string_agg(CAST(CAST(pos AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(pos + length(part) AS BIGINT) AS VARCHAR), ',' ORDER BY k)
                FILTER (out), '') AS removed,
       md5(coalesce(string_agg(part, chr(10) ORDER BY k) FILTER (NOT out), '')) AS kept_md5
FROM whole LEFT JOIN longest USING (doc_id) GROUP BY doc_id
"""


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


OP4_SQL = f"""
WITH known(license_id, body) AS (VALUES {", ".join("(%s)" % ", ".join("'" + v.replace("'", "''") + "'" for v in row) for row in licenses.KNOWN)}),
digests AS (SELECT sha256({licenses.canonical_sql("body")}) AS digest, min(license_id) AS license_id FROM known GROUP BY 1),
own AS (SELECT doc_id, sha256({licenses.canonical_sql("text")}) AS digest FROM documents)
SELECT doc_id, digest, license_id FROM own LEFT JOIN digests USING (digest)
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select(
        warc.page_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"),
    )


OP5_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
h AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS h FROM p),
d AS (SELECT page_id, n, array_to_string([substr('{warc.BASE32}', CAST(1 +
      ((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) AS INTEGER), 1) for i in range(32)], '') AS digest FROM h),
m AS (SELECT digest, max(page_id) AS latest FROM d GROUP BY digest)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = latest THEN NULL ELSE latest END AS refers_to
FROM d JOIN m USING (digest)
"""


def op6_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen, rejected = preference.with_repeated_reply(table(spark, sf_dir, "conversations"))
    return preference.format_pairs(chosen, rejected)


OP6_SQL = """
WITH c AS (SELECT DISTINCT conv_id AS pair_id, turn, role, text FROM conversations),
replies AS (SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn, text) AS up,
            row_number() OVER (PARTITION BY pair_id ORDER BY turn DESC, text DESC) AS down FROM c WHERE role = 'assistant'),
ends AS (SELECT l.pair_id, l.turn, l.text, CASE WHEN l.up = 1 THEN '' ELSE f.text END AS other
         FROM replies l JOIN replies f ON l.pair_id = f.pair_id AND f.up = 1 AND l.down = 1),
r AS (SELECT DISTINCT c.pair_id, c.turn, c.role, CASE WHEN e.pair_id IS NULL THEN c.text ELSE e.other END AS text
      FROM c LEFT JOIN ends e ON c.pair_id = e.pair_id AND c.turn = e.turn AND c.text = e.text AND c.role = 'assistant'),
both_sides AS (SELECT *, 'chosen' AS side FROM c UNION ALL SELECT *, 'rejected' FROM r),
turns AS (SELECT pair_id, turn, role, text, count(*) AS sides, min(side) AS side FROM both_sides GROUP BY pair_id, turn, role, text),
apart AS (SELECT pair_id, min(turn) AS first FROM turns WHERE sides = 1 GROUP BY pair_id),
common AS (SELECT t.*, first IS NULL OR turn < first AS prompt FROM turns t LEFT JOIN apart USING (pair_id)),
parts AS (SELECT pair_id, turn, role, text, 'prompt' AS part FROM common WHERE prompt
          UNION ALL SELECT pair_id, turn, role, text, side FROM common WHERE NOT prompt
          UNION ALL SELECT pair_id, turn, role, text, 'rejected' FROM common WHERE NOT prompt AND sides = 2),
done AS (SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS rendered FROM parts)
SELECT pair_id, part, turn, role, rendered, CAST(CASE WHEN part <> 'prompt' AND role = 'assistant' THEN length(role) + 5
       ELSE length(rendered) END AS BIGINT) AS loss_start, CAST(length(rendered) AS BIGINT) AS loss_end
FROM done
"""


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit_sample(docs))
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256"), "spans")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontaminate.search(docs, decontaminate.build_index(docs, table(spark, sf_dir, "benchmark")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality.learn_from(docs, table(spark, sf_dir, "labels"))
    return quality.judge(docs, rules)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.components_of(rows, whitening.fit(rows))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)
    whole = bpe.decode(bpe.encode(docs, path, bpe.build_lexicon(docs, path)), path)
    return whole.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.score(docs, alignment.pair_counts(docs, *paths), *paths)


QUERIES = {
    "op1_packing": op1_packing,
    "op2_line_dedup": op2_line_dedup,
    "op3_simhash": op3_simhash,
    "op4_licenses": op4_licenses,
    "op5_warc": op5_warc,
    "op6_preference": op6_preference,
    "op7_pii": op7_pii,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality": op9_quality,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_bpe": op12_bpe,
    "op13_alignment": op13_alignment,
}
# Fingerprints, tokenizers and learned models have no SQL form: their queries are tested against brute force.
ORACLES = {"op2_line_dedup": OP2_SQL, "op4_licenses": OP4_SQL, "op5_warc": OP5_SQL, "op6_preference": OP6_SQL}
