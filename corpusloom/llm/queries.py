"""The queries of this subpackage: name to callable(spark, sf_dir), and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, changes, chat, exact_dedup, langid, license_scan, merkle, mixing, near_dedup, packing, suffix_dedup, toxicity, warc
from .shared import tune


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in ``documents``; see :func:`license_scan.scan`."""
    return license_scan.scan(_table(spark, sf_dir, "documents")).drop("spans")


def op2_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as WARC archives and read back; see :func:`warc.round_trip`."""
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("target_uri")


OP2_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
     h AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS s FROM p),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS first FROM h)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(s, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS BIGINT), 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def op3_hyperminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of ``documents``; see :func:`near_dedup.near_groups`."""
    return near_dedup.near_groups(_table(spark, sf_dir, "documents"))


def op4_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue of ``conversations`` from every participant's side; see :func:`chat.rotate`."""
    return chat.rotate(_table(spark, sf_dir, "conversations"))


_NAME = "speaker"
for _ch, _code in chat.NAME_ESCAPES.items():
    _NAME = f"replace({_NAME}, chr({ord(_ch)}), '{_code}')"

OP4_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
     n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, speaker, text) - 1 AS seq FROM t),
     people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
     r AS (SELECT n.conv_id, perspective, seq, turn, speaker,
                  CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role, text
           FROM n JOIN people p ON n.conv_id IS NOT DISTINCT FROM p.conv_id),
     h AS (SELECT *, '<|im_start|>' || CASE role WHEN 'user' THEN 'user name=' || {NAME} ELSE role END || chr(10) AS head FROM r),
     s AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS segment FROM h),
     p AS (SELECT *, CAST(coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM s)
SELECT conv_id, perspective, seq, turn, speaker, role, segment, start, length(segment) AS length,
       start + CASE role WHEN 'assistant' THEN length(head) ELSE 0 END AS mask_start,
       CASE role WHEN 'assistant' THEN length(text) + 11 ELSE 0 END AS mask_length
FROM p
""".replace("{NAME}", _NAME)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` packed into sequences of 4096 tokens; see :func:`packing.cut` and :func:`packing.pack`."""
    return packing.pack(packing.cut(_table(spark, sf_dir, "documents")))


def op6_heavy_hitter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of ``documents``; see :func:`exact_dedup.exact_groups`."""
    out = exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
"""


def op7_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of ``documents``; see :func:`langid.learn` and :func:`langid.predict`."""
    docs = _table(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.learn(docs.filter(~langid.held_out())))
    return out.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op8_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours in ``embeddings`` of every row whose id is divisible by 20; see :func:`ann.search`."""
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of ``documents``; see :func:`toxicity.learn` and :func:`toxicity.predict`."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = toxicity.predict(docs, toxicity.learn(docs, labels.filter(~langid.held_out())))
    return out.select("doc_id", langid.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents`` by source; see :func:`mixing.mix`."""
    out = mixing.mix(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_bwt_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated strings of 400 bytes in ``documents``; see :func:`suffix_dedup.remove_repeats`."""
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return out.select("doc_id", "n_bytes", removed.cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_change_applier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``client_changes`` applied in the order of their numbers; see :func:`changes.apply_changes`."""
    out = changes.apply_changes(_table(spark, sf_dir, "client_changes"))
    return out.select("change_id", "client_id", "status", "batch", "missed", "city", changes.cents(F.col("balance")).alias("cents"), "current")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaves, roots and proofs of ``documents``, some tampered with; see :func:`merkle.manifest` and :func:`merkle.fold`."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    tampered = F.when(changed, merkle.leaf(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields]))
    out = merkle.manifest(_table(spark, sf_dir, "documents"), fields, carry={"tampered": tampered})
    folded = merkle.fold(F.coalesce("tampered", "leaf"), F.col("proof"), F.col("path"))
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


#: CRC-32 of a short ASCII string ``s``: eight steps a byte over the reflected polynomial 0xEDB88320.
_CRC = "list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(s, ''), lambda c: ascii(c)::BIGINT)), lambda acc, b: {8})"
_step = "xor(acc, b)"
for _ in range(8):
    _step = f"list_transform([{_step}], lambda v: xor(v >> 1, (v & 1) * 3988292384))[1]"
CRC32_SQL = f"xor({_CRC.replace('{8}', _step)}, 4294967295)"

OP13_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, source, n_chars, text, (CRC32) % 7 = 0 AS tampers FROM (SELECT *, CAST(doc_id AS VARCHAR) AS s FROM documents)),
v AS (
  SELECT doc_id, lang, tampers AND n_chars IS NOT NULL AS changed, FIELD(CAST(doc_id AS VARCHAR)) || FIELD(source) || FIELD(lang) AS head,
         FIELD(CAST(n_chars AS VARCHAR)) AS size, FIELD(CAST(n_chars + 1 AS VARCHAR)) AS size1, FIELD(text) AS tail FROM d),
leaves AS (
  SELECT doc_id, lang, sha256(head || size || tail) AS h, changed, sha256(head || size1 || tail) AS t FROM v),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS p, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
up AS (
  SELECT 0 AS k, lang, p, h, n FROM placed
  UNION ALL
  SELECT k + 1, lang, p // 2, sha256(string_agg(h, '' ORDER BY p)), any_value((n + 1) // 2) FROM up WHERE n > 1 GROUP BY k + 1, lang, p // 2),
subs AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (
  SELECT 0 AS k, p, h, n FROM subs
  UNION ALL
  SELECT k + 1, p // 2, sha256(string_agg(h, '' ORDER BY p)), any_value((n + 1) // 2) FROM top WHERE n > 1 GROUP BY k + 1, p // 2),
own AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, 0 AS k, p, xor(p, 1) AS sib, n, CASE WHEN changed THEN t ELSE h END AS h, '' AS proof FROM placed
  UNION ALL
  SELECT f.doc_id, f.g, f.k + 1, f.p // 2, xor(f.p // 2, 1), (f.n + 1) // 2,
         CASE WHEN f.p % 2 = 1 THEN sha256(x.h || f.h) ELSE sha256(f.h || coalesce(x.h, '')) END, f.proof || coalesce(x.h, '')
  FROM own f LEFT JOIN (SELECT coalesce('=' || lang, '') AS g, k, p, h FROM up) x ON x.g = f.g AND x.k = f.k AND x.p = f.sib WHERE f.n > 1),
"over" AS (
  SELECT doc_id, 0 AS k, s.p, xor(s.p, 1) AS sib, s.n, f.h, proof, f.g FROM own f JOIN subs s ON f.g = coalesce('=' || s.lang, '') WHERE f.n = 1
  UNION ALL
  SELECT f.doc_id, f.k + 1, f.p // 2, xor(f.p // 2, 1), (f.n + 1) // 2,
         CASE WHEN f.p % 2 = 1 THEN sha256(x.h || f.h) ELSE sha256(f.h || coalesce(x.h, '')) END, f.proof || coalesce(x.h, ''), f.g
  FROM "over" f LEFT JOIN top x ON x.k = f.k AND x.p = f.sib WHERE f.n > 1)
SELECT l.doc_id, l.h AS leaf, s.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM "over" f JOIN placed l ON f.doc_id = l.doc_id AND f.n = 1 JOIN subs s ON coalesce('=' || s.lang, '') = f.g CROSS JOIN (SELECT h FROM top WHERE n = 1) r
"""
for _c in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", "CAST(n_chars + 1 AS VARCHAR)", "text"):
    OP13_SQL = OP13_SQL.replace(f"FIELD({_c})", f"coalesce(strlen({_c}) || ':' || {_c}, '-')")
OP13_SQL = OP13_SQL.replace("CRC32", CRC32_SQL)

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_warc_round_trip": op2_warc_round_trip,
    "op3_hyperminhash_dedup": op3_hyperminhash_dedup,
    "op4_perspective_rotation": op4_perspective_rotation,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_heavy_hitter_dedup": op6_heavy_hitter_dedup,
    "op7_ppm_language": op7_ppm_language,
    "op8_learned_partitions": op8_learned_partitions,
    "op9_boosted_toxicity": op9_boosted_toxicity,
    "op10_pivotal_mix": op10_pivotal_mix,
    "op11_bwt_merge_dedup": op11_bwt_merge_dedup,
    "op12_change_applier": op12_change_applier,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES = {"op4_perspective_rotation": OP4_SQL, "op2_warc_round_trip": OP2_SQL, "op6_heavy_hitter_dedup": OP6_SQL, "op13_merkle_manifest": OP13_SQL}
