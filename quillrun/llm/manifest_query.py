"""The query of the Merkle manifest, and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillrun.llm.merkle import build_manifest, folded, leaf_digest, proof_digest, proofs
from quillrun.llm.registry import query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(_field_sql(c) for c in [*FIELDS[:-1], text])})"


@query("op11_merkle_manifest", f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
           lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
marked AS (
  SELECT d.*, coalesce(xor(list_reduce(list_concat([4294967295],
             list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
             lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 3 = 0, false) AS tampered
  FROM documents d, crc),
hashed AS (
  SELECT lang, doc_id, {_leaf_sql('text')} AS leaf,
         CASE WHEN tampered THEN {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")}
              ELSE {_leaf_sql('text')} END AS claimed
  FROM marked),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS idx,
         count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
up AS (
  SELECT lang, 0 AS level, idx, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM up
  WHERE n > 1 GROUP BY lang, level, idx // 8, n),
subroots AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM up WHERE n = 1),
over_ AS (
  SELECT 0 AS level, idx, n, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM over_
  WHERE n > 1 GROUP BY level, idx // 8, n),
steps AS (
  SELECT l.lang, l.idx, u.level,
         coalesce(string_agg(u.h, '' ORDER BY u.idx) FILTER (u.idx < l.idx // CAST(pow(8, u.level) AS BIGINT)), '') AS b,
         coalesce(string_agg(u.h, '' ORDER BY u.idx) FILTER (u.idx > l.idx // CAST(pow(8, u.level) AS BIGINT)), '') AS a
  FROM leaves l JOIN up u ON l.lang IS NOT DISTINCT FROM u.lang AND u.n > 1
    AND u.idx // 8 = l.idx // CAST(pow(8, u.level + 1) AS BIGINT)
  GROUP BY l.lang, l.idx, u.level),
own AS (SELECT lang, idx, list(b || '#' || a ORDER BY level) AS path FROM steps GROUP BY lang, idx),
top_steps AS (
  SELECT s.idx, o.level,
         coalesce(string_agg(o.h, '' ORDER BY o.idx) FILTER (o.idx < s.idx // CAST(pow(8, o.level) AS BIGINT)), '') AS b,
         coalesce(string_agg(o.h, '' ORDER BY o.idx) FILTER (o.idx > s.idx // CAST(pow(8, o.level) AS BIGINT)), '') AS a
  FROM subroots s JOIN over_ o ON o.n > 1 AND o.idx // 8 = s.idx // CAST(pow(8, o.level + 1) AS BIGINT)
  GROUP BY s.idx, o.level),
tops AS (SELECT idx, list(b || '#' || a ORDER BY level) AS path FROM top_steps GROUP BY idx),
whole AS (
  SELECT l.doc_id, l.leaf, l.claimed, s.subroot, (SELECT h FROM over_ WHERE n = 1) AS root,
         list_concat(coalesce(o.path, []), coalesce(t.path, [])) AS path
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  LEFT JOIN own o ON l.lang IS NOT DISTINCT FROM o.lang AND l.idx = o.idx
  LEFT JOIN tops t ON s.idx = t.idx)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '#', '')) AS proof_sha256,
       list_reduce(list_concat([claimed], path),
         lambda x, s: sha256(split_part(s, '#', 1) || x || split_part(s, '#', 2))) AS folded_root,
       list_reduce(list_concat([claimed], path),
         lambda x, s: sha256(split_part(s, '#', 1) || x || split_part(s, '#', 2))) = root AS verified
FROM whole
""")
def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tampered = leaf_digest([*[F.col(c) for c in FIELDS[:-1]], F.translate("text", UPPER, LOWER)])
    chosen = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = proofs(build_manifest(docs, FIELDS, claimed=F.when(chosen, tampered)))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("claimed", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
