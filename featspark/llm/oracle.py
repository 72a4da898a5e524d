"""DuckDB SQL for the corpus queries that SQL can express."""

_WORD = r"[^\x20\x09-\x0D]+"
_KEY = "('0x' || substr(md5({0}), 1, 15))::BIGINT"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
         {_KEY.format("'17:' || coalesce(doc_id::VARCHAR, '')")} AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
         3.0::DOUBLE * source_size AS cap, sum(source_size) OVER ()::DOUBLE AS budget FROM s),
l AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM w),
t AS (
  SELECT source, source_size, least(weight * (SELECT level FROM l WHERE level <= cap / weight ORDER BY place LIMIT 1), cap) AS target
  FROM l),
q AS (
  SELECT d.doc_id, d.source, d.size, d.key, t.source_size, t.target,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, (k * source_size + upto)::DOUBLE / target AS fin
  FROM q, (VALUES (0), (1), (2)) AS r(k) WHERE size > 0),
o AS (
  SELECT doc_id, key, size, source,
         sum(size) OVER (ORDER BY fin, k, key, doc_id, size ROWS UNBOUNDED PRECEDING) AS used FROM c),
n AS (
  SELECT doc_id, key, size, source, count(*) AS copies FROM o
  WHERE used <= (SELECT sum(size) FROM d) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, (coalesce(n.copies, 0) * q.size)::BIGINT AS taken, q.source,
       CASE WHEN q.target > 0 THEN q.upto::DOUBLE / q.target END AS finish
FROM q LEFT JOIN n ON q.doc_id = n.doc_id AND q.source IS NOT DISTINCT FROM n.source"""

OP5 = f"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, coalesce(text, '') AS text,
         {_KEY.format("coalesce(text, '')")} AS k1,
         {_KEY.format("coalesce(doc_id::VARCHAR, '')")} AS k2
  FROM documents),
p AS (
  SELECT *, sum(size) OVER (ORDER BY k1, k2, doc_id ROWS UNBOUNDED PRECEDING) - size AS before,
         sum(size) OVER () AS total, row_number() OVER (ORDER BY k1, k2, doc_id) AS pos FROM d),
s AS (SELECT *, (before * 16 // total)::INT AS shard FROM p)
SELECT doc_id, size, shard, pos - min(pos) OVER (PARTITION BY shard) AS slot FROM s"""

OP7 = f"""
WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""

ORACLE = {"op2_fair_queue_mix": OP2, "op7_chunk_recipe_dedup": OP7}
