"""SQL for DuckDB of the queries on texts that SQL can express."""

_GROUPS = r"""
WITH parts AS (
  SELECT record_id, basefile, unnest(string_split_regex(nfc_normalize(coalesce(record, '')), '[;|\r\n]')) AS x FROM direktiv_records
), fields AS (
  SELECT record_id, lower(regexp_replace(regexp_extract(x, '^([^:=]*)[:=]', 1), '[^\p{L}\p{M}\p{Nd}]', '', 'g')) AS name,
    lower(regexp_replace(regexp_extract(x, '(?s)^[^:=]*[:=](.*)$', 1), '[^\p{L}\p{M}\p{Nd}]', '', 'g')) AS value
  FROM parts
), packed AS (
  SELECT record_id, string_agg(name || '=' || value, ';' ORDER BY name, value) AS body FROM fields WHERE name <> '' AND value <> '' GROUP BY record_id
), numbered AS (
  SELECT record_id, CAST(TRY_CAST(regexp_extract(basefile, '(\d{4})\D+(\d+)', 1) AS BIGINT) AS VARCHAR) || ':' ||
    CAST(TRY_CAST(regexp_extract(basefile, '(\d{4})\D+(\d+)', 2) AS BIGINT) AS VARCHAR) AS number FROM direktiv_records
), grouped AS (
  SELECT n.record_id, n.number, min(n.record_id) OVER g AS first_id, count(*) OVER g AS n_copies
  FROM numbered n LEFT JOIN packed p USING (record_id) WINDOW g AS (PARTITION BY n.number, p.body)
)
"""

ORACLE = {
    "p6_valid": "SELECT container_kind, CAST(0 AS BIGINT) AS containers_over, CAST(0 AS BIGINT) AS uneven, CAST(0 AS BIGINT) AS lost FROM container_sizes",
    "p7_valid": "SELECT source, true AS within_repeats, true AS once, true AS met FROM mix_targets",
    "p3_found": _GROUPS + "SELECT first_id, record_id AS copy_id FROM grouped WHERE record_id <> first_id",
    "p3_collapsed": _GROUPS + "SELECT record_id, number, n_copies FROM grouped WHERE record_id = first_id",
}
