"""The opN_ queries: each applies one operator to its whole table."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosemill.llm.fingerprints import compare_neighbours
from prosemill.llm.packing import pack_documents
from prosemill.llm.pieces import decode_pieces, encode_pieces
from prosemill.llm.quality import score_quality
from prosemill.llm.runtime import checkpoint_root, cut, in_fold, table
from prosemill.llm.secrets import findings, scan_versions, written
from prosemill.llm.simhash import simhash_groups
from prosemill.llm.suffixes import remove_repeats
from prosemill.llm.toxicity import score_toxicity
from prosemill.llm.vectors import link_vectors
from prosemill.llm.warc import arc_to_warc, http_number, pages_to_arc, read_warc, with_revisits, write_warc


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file; PROSEMILL_TOKENIZERS names another folder."""
    if folder := os.environ.get("PROSEMILL_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _verdicts(scored: DataFrame, held_out: Column) -> DataFrame:
    return scored.select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of fold 0 of 5 are never learned from."""
    held_out = in_fold(F.col("doc_id"), 5, 0)
    scored = score_toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), usable=~held_out)
    return _verdicts(scored, held_out)


def op2_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place; ids_crc32 is of its little-endian ids."""
    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's piece ids, and whether they decode to it."""
    docs, model = table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model")
    decoded = decode_pieces(encode_pieces(docs, model), model)
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), F.sha2("text", 256).alias("decoded_sha256"))


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as legacy archives, converted, written as WARC with revisits, and read back."""
    records = arc_to_warc(pages_to_arc(table(spark, sf_dir, "pages")))
    path = f"{checkpoint_root(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(with_revisits(records.withColumn("page_id", http_number("X-Page-Id")), "page_id"), path)
    back = read_warc(spark, path).filter(F.col("warc_type").isin("response", "revisit"))
    full = F.coalesce("payload_digest", "declared_digest")
    rows = cut(back.select("record_id", "warc_type", "refers_to", http_number("X-Page-Id").alias("page_id"), F.coalesce(F.octet_length("payload").cast("long"), http_number("Content-Length")).alias("payload_bytes"), full.alias("payload_digest")))
    responses = rows.filter("warc_type = 'response'").select(F.col("record_id").alias("of"), F.col("page_id").alias("of_page"))
    joined = rows.join(responses, F.col("refers_to") == F.col("of"), "left")
    return joined.select("page_id", "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), F.col("of_page").alias("refers_to"))


def op5_minhash_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how like they are."""
    compared = compare_neighbours(table(spark, sf_dir, "documents"))
    return compared.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, from a ledger that starts empty."""
    found = findings(*scan_versions(table(spark, sf_dir, "documents")))
    base = found.withColumn("base", F.filter("found", lambda s: s["base"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return base.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors at cosine 0.9 or more."""
    return link_vectors(table(spark, sf_dir, "embeddings"), 0.9)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document stands in an earlier one too, by strings of 50 bytes."""
    kept = remove_repeats(table(spark, sf_dir, "documents"), 50)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of fold 1 of 3 are never learned from."""
    held_out = in_fold(F.col("doc_id"), 3, 1)
    scored = score_quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), usable=~held_out)
    return _verdicts(scored, held_out)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_harmonic_packing, op3_piece_viterbi, op4_arc_to_warc, op5_minhash_fingerprint, op6_secret_scan, op7_embedding_near_dedup, op8_simhash_near_dedup, op9_suffix_dedup, op10_rule_quality)}


_ARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(h, CAST(1 + 5 * (k // 4) AS BIGINT), 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) AS BIGINT) + 1, 1)), '') AS payload_digest FROM p),
m AS (SELECT payload_digest AS digest, max(page_id) AS first_id FROM d GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d JOIN m ON d.payload_digest = m.digest"""

_LINKS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
number AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT v.vec_id, CAST(coalesce(number.n, 0) AS BIGINT) AS n_links, low.component_id, v.vec_id = low.component_id AS kept
FROM v JOIN low ON v.vec_id = low.x LEFT JOIN number ON v.vec_id = number.x"""


def _spans_sql(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    """Rows (doc_id, start, ord, kind, stop): matches and the texts between them alternate, so starts are sums of lengths."""
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start, {order} AS ord, '{kind}' AS kind, length(m[i]) AS size, length(c[i]) AS checked
    FROM (SELECT doc_id, m, g, c, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT doc_id, regexp_extract_all(t, '{quoted}') AS m, string_split_regex(t, '{quoted}') AS g, regexp_extract_all(t, '{quoted}', {group}) AS c
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents) d) e) f
    WHERE length(c[i]) >= {least}"""


_BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
)
_PEM = (*_BASE, ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1))


def _scan_sql() -> str:
    rows = " UNION ALL ".join(_spans_sql(kind, k, *rest) for k, (kind, *rest) in enumerate(_PEM))
    text = "string_agg(kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(start + size AS VARCHAR), ',' ORDER BY start, ord)"
    base = "string_agg(kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(start + size AS VARCHAR), ',' ORDER BY start, ord) FILTER (ord < 3)"
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind, *_ in _BASE)
    kept = ", ".join(f"CAST(coalesce(n_{kind}, 0) AS BIGINT) AS n_{kind}" for kind, *_ in _BASE)
    return f"""WITH s AS ({rows}), a AS (SELECT doc_id AS of, {counts}, {base} AS base, {text} AS spans FROM s GROUP BY doc_id)
    SELECT doc_id, {kept}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN a ON doc_id = a.of"""


def oracle_sql() -> dict[str, str]:
    return {"op4_arc_to_warc": _ARC_SQL, "op6_secret_scan": _scan_sql(), "op7_embedding_near_dedup": _LINKS_SQL}
