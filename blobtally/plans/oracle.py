"""Reference SQL for every catalogued query, runnable by DuckDB over the base testdata tables.

The driver registers only the base tables, so every text carries the fixture derivations
(FIXTURES.md §3) and the derived steps as WITH clauses. Column names equal the Spark side's.
"""

from __future__ import annotations

from blobtally.sources.fixtures import FILES_PER_GROUP, GROUPS_PER_TAIL, MAX_BYTES

LONG_MAX = "9223372036854775807"

FIXTURE_CTES = """
fx_blob_index AS (
  SELECT concat(l_orderkey,'-',l_linenumber) AS uri, CAST(floor(l_orderkey/4) AS BIGINT) AS file_id,
         concat('b',l_orderkey,'-',l_linenumber) AS blob_id,
         CAST(coalesce(sum(q) OVER (PARTITION BY CAST(floor(l_orderkey/4) AS BIGINT) ORDER BY l_orderkey,l_linenumber
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS BIGINT) AS start, q AS length
  FROM (SELECT l_orderkey, l_linenumber, max(CAST(l_quantity AS BIGINT))*1024 AS q
        FROM lineitem GROUP BY l_orderkey, l_linenumber) d),
fx_objects AS (
  SELECT concat(CASE o_orderstatus WHEN 'F' THEN 'archive' WHEN 'O' THEN 'archived2' ELSE 'photos' END,'/',o_orderkey) AS object_key,
         CASE WHEN o_orderkey%50=7 THEN '' ELSE u END AS uri,
         CASE WHEN o_orderkey%41=3 THEN 0 WHEN o_orderkey%43=5 THEN NULL ELSE size END AS size
  FROM orders LEFT JOIN (
    SELECT k, string_agg(t, ',' ORDER BY n) AS u, CAST(sum(q) AS BIGINT) AS size FROM (
      SELECT l_orderkey AS k, l_linenumber AS n, max(CAST(l_quantity AS BIGINT))*1024 AS q,
             concat(l_orderkey,'-',l_linenumber, CASE WHEN l_linenumber=7 THEN ',' ELSE '' END) AS t
      FROM lineitem GROUP BY l_orderkey, l_linenumber
      UNION ALL SELECT o_orderkey, 9, 1024, concat(o_orderkey,'-9') FROM orders WHERE o_orderkey%10=0) x
    GROUP BY k) a ON a.k=o_orderkey),
fx_file_index AS (
  SELECT file_id, CASE WHEN file_id%97=11 THEN NULL ELSE concat('/blobstore/f',file_id) END AS path
  FROM (SELECT DISTINCT CAST(floor(o_orderkey/4) AS BIGINT) AS file_id FROM orders) o WHERE file_id%89<>13),
fx_file_lengths AS (
  SELECT concat('/blobstore/f',file_id) AS path,
         CAST(CASE WHEN file_id%53=2 THEN 0 WHEN file_id%59=4 THEN floor(sum(length)/2) ELSE sum(length) END AS BIGINT) AS length
  FROM fx_blob_index WHERE file_id%61<>5 GROUP BY file_id)"""

DERIVED_CTES = """
ox_valid AS (
  SELECT object_key, uri, size FROM fx_objects WHERE uri IS NOT NULL AND uri <> '' AND size IS NOT NULL),
ox_refs AS (
  SELECT object_key, uri, size
  FROM (SELECT object_key, unnest(string_split(uri, ',')) AS uri, size FROM ox_valid) e
  WHERE uri <> '' AND size <> 0),
ox_resolved AS (
  SELECT r.object_key, r.uri, r.size, b.file_id, b.blob_id, b.start, b.length
  FROM ox_refs r JOIN fx_blob_index b ON b.uri = r.uri),
ox_totals AS (
  SELECT file_id, count(*) AS n_refs,
         count(*) FILTER (WHERE NOT starts_with(object_key, 'archive/')) AS n_live,
         CAST(coalesce(sum(length) FILTER (WHERE NOT starts_with(object_key, 'archive/')), 0) AS BIGINT) AS remain_size,
         bool_and(starts_with(object_key, 'archive/')) AS all_archived
  FROM ox_resolved GROUP BY file_id),
ox_paths AS (
  SELECT t.file_id, f.path, t.n_refs, t.n_live, t.remain_size, t.all_archived
  FROM ox_totals t JOIN fx_file_index f ON f.file_id = t.file_id WHERE f.path IS NOT NULL),
ox_lengths AS (
  SELECT p.file_id, p.path, p.n_refs, p.n_live, p.remain_size, p.all_archived, l.length
  FROM ox_paths p LEFT JOIN fx_file_lengths l ON l.path = p.path
  WHERE p.all_archived OR l.length IS NOT NULL),
ox_status AS (
  SELECT file_id,
         CAST(CASE WHEN all_archived THEN -1 WHEN length = 0 THEN -1
                   ELSE ((length - remain_size) * 100) // length END AS INTEGER) AS "emptyPercent",
         CAST(CASE WHEN all_archived THEN 9223372036854775807 ELSE remain_size END AS BIGINT) AS "remainSize",
         path, false AS deleted
  FROM ox_lengths),
ox_meta AS (
  SELECT concat(CAST(r.file_id AS VARCHAR), '_', r.blob_id) AS "meatRowKey", r.object_key AS "objectKey",
         r.start, r.length
  FROM ox_resolved r
  WHERE NOT starts_with(r.object_key, 'archive/') AND r.file_id IN (SELECT file_id FROM ox_status))"""

# Sequential split packing per pack group, as a recursive CTE (saturating sum, close at cap).
SPLIT_CTES = f"""
ox_order AS (
  SELECT file_id, CAST(file_id // {FILES_PER_GROUP} AS BIGINT) AS g, "remainSize" AS remain,
         row_number() OVER (PARTITION BY file_id // {FILES_PER_GROUP} ORDER BY file_id) AS rn
  FROM ox_status),
ox_pack AS (
  SELECT g, rn, file_id, remain, 0 AS split_id, remain AS cur FROM ox_order WHERE rn = 1
  UNION ALL
  SELECT o.g, o.rn, o.file_id, o.remain,
         CASE WHEN p.cur >= {MAX_BYTES} THEN p.split_id + 1 ELSE p.split_id END,
         CASE WHEN p.cur >= {MAX_BYTES} THEN o.remain
              ELSE CAST(least(CAST(p.cur AS HUGEINT) + o.remain, {LONG_MAX}) AS BIGINT) END
  FROM ox_pack p JOIN ox_order o ON o.g = p.g AND o.rn = p.rn + 1)"""

# The open last splits of every GROUPS_PER_TAIL groups, packed again in group order.
TAIL_CTES = f"""
ox_tails AS (
  SELECT g, split_id FROM (
    SELECT g, split_id, sum(CAST(remain AS HUGEINT)) AS size, max(split_id) OVER (PARTITION BY g) AS last
    FROM ox_pack GROUP BY g, split_id) WHERE split_id = last AND size < {MAX_BYTES}),
ox_tail_order AS (
  SELECT p.file_id, -1 - CAST(p.g // {GROUPS_PER_TAIL} AS BIGINT) AS g, p.remain,
         row_number() OVER (PARTITION BY p.g // {GROUPS_PER_TAIL} ORDER BY p.g, p.file_id) AS rn
  FROM ox_pack p JOIN ox_tails t ON t.g = p.g AND t.split_id = p.split_id),
ox_tail_pack AS (
  SELECT g, rn, file_id, remain, 0 AS split_id, remain AS cur FROM ox_tail_order WHERE rn = 1
  UNION ALL
  SELECT o.g, o.rn, o.file_id, o.remain,
         CASE WHEN p.cur >= {MAX_BYTES} THEN p.split_id + 1 ELSE p.split_id END,
         CASE WHEN p.cur >= {MAX_BYTES} THEN o.remain
              ELSE CAST(least(CAST(p.cur AS HUGEINT) + o.remain, {LONG_MAX}) AS BIGINT) END
  FROM ox_tail_pack p JOIN ox_tail_order o ON o.g = p.g AND o.rn = p.rn + 1)"""

# One fold over the whole table.
TABLE_SPLIT_CTES = f"""
ox_all AS (SELECT file_id, "remainSize" AS remain, row_number() OVER (ORDER BY file_id) AS rn FROM ox_status),
ox_fold AS (
  SELECT rn, file_id, 0 AS split_id, CAST(remain AS HUGEINT) AS cur FROM ox_all WHERE rn = 1
  UNION ALL
  SELECT o.rn, o.file_id, CASE WHEN p.cur >= {MAX_BYTES} THEN p.split_id + 1 ELSE p.split_id END,
         CASE WHEN p.cur >= {MAX_BYTES} THEN o.remain ELSE p.cur + o.remain END
  FROM ox_fold p JOIN ox_all o ON o.rn = p.rn + 1)"""

# Meta rows of a file in order, in lists of five.
LIST_CTES = """
ox_placed AS (
  SELECT CAST(split_part("meatRowKey", '_', 1) AS BIGINT) AS file_id, "meatRowKey", "objectKey", start, length,
         row_number() OVER (PARTITION BY split_part("meatRowKey", '_', 1) ORDER BY start, "meatRowKey", "objectKey") - 1 AS n FROM ox_meta),
ox_listed AS (SELECT *, CAST(n // 5 AS BIGINT) AS list_no, n % 5 AS place FROM ox_placed)"""

# References kept by the md5 of (object, place in its list, uri): 0.375 = 0x6/16.
THIN_CTES = """
ox_numbered AS (
  SELECT object_key, unnest(string_split(uri, ',')) AS uri, generate_subscripts(string_split(uri, ','), 1) - 1 AS ref_no, size FROM ox_valid),
ox_kept AS (
  SELECT r.object_key, b.file_id, b.blob_id, b.start, b.length, NOT starts_with(r.object_key, 'archive/') AS live
  FROM ox_numbered r JOIN fx_blob_index b ON b.uri = r.uri
  WHERE r.uri <> '' AND r.size <> 0 AND md5(concat_ws('|', r.object_key, r.ref_no, r.uri)) < '6'),
ox_thin AS (
  SELECT file_id, count(*) AS n_refs, count(*) FILTER (WHERE live) AS n_live,
         CAST(coalesce(sum(length) FILTER (WHERE live), 0) AS BIGINT) AS remain_size, bool_and(NOT live) AS all_archived
  FROM ox_kept GROUP BY file_id),
ox_thin_files AS (
  SELECT t.file_id FROM ox_thin t JOIN fx_file_index f ON f.file_id = t.file_id LEFT JOIN fx_file_lengths l ON l.path = f.path
  WHERE f.path IS NOT NULL AND (t.all_archived OR l.length IS NOT NULL))"""

CELL_CTES = """
ox_cells AS (
  SELECT encode(lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS rk, encode('f') AS fam, encode('name') AS qual,
         encode(c_name) AS val FROM customer WHERE c_name IS NOT NULL
  UNION ALL
  SELECT encode(lpad(CAST(c_custkey AS VARCHAR), 9, '0')), encode('f'), encode('segment'),
         encode(c_mktsegment) FROM customer WHERE c_mktsegment IS NOT NULL)"""

START_KEY_CTES = """
ox_starts AS (
  SELECT encode(lpad(CAST(s_suppkey * 13 AS VARCHAR), 9, '0')) AS start_key,
         row_number() OVER (ORDER BY s_suppkey) - 1 AS rank FROM supplier),
ox_regions AS (
  SELECT c.rk, c.fam, c.qual, c.val, CAST(coalesce(s.rank, 0) AS BIGINT) AS region
  FROM ox_cells c ASOF LEFT JOIN ox_starts s ON c.rk >= s.start_key)"""

RUN_BASE = "/data/blobstore/"
RUN_CTES = f"""
ox_runs AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, epoch_ms(o_orderdate) AS millis FROM orders),
ox_run_paths AS (
  SELECT o_orderkey,
         concat('{RUN_BASE}aggregator/', day, '/', CAST(millis AS VARCHAR), '/file_status') AS status_path,
         concat('{RUN_BASE}aggregator/', day, '/', CAST(millis AS VARCHAR), '/file_meta') AS meta_path
  FROM ox_runs)"""


def _with(body: str, *extra: str, recursive: bool = False) -> str:
    ctes = ",".join([FIXTURE_CTES, DERIVED_CTES, *extra])
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


ORACLE_SQL: dict[str, str] = {
    "object_scan": _with(
        "SELECT hex(encode(object_key)) AS row_key_hex, hex(encode(uri)) AS uri_hex,"
        " CASE WHEN size IS NULL THEN NULL ELSE lpad(hex(size), 16, '0') END AS size_hex FROM fx_objects"),
    "valid_objects": _with("SELECT object_key, uri, size FROM ox_valid"),
    "decode_cells": _with("SELECT object_key, uri, size FROM fx_objects"),
    "object_refs": _with("SELECT object_key, uri, size FROM ox_refs"),
    "resolve_refs": _with("SELECT object_key, uri, size, file_id, blob_id, start, length FROM ox_resolved"),
    "unresolved_refs": _with(
        "SELECT r.object_key, r.uri, r.size FROM ox_refs r"
        " WHERE NOT EXISTS (SELECT 1 FROM fx_blob_index b WHERE b.uri = r.uri)"),
    "lookup_counters": _with(
        "SELECT count(*) FILTER (WHERE b.uri IS NOT NULL) AS hits,"
        " count(*) FILTER (WHERE b.uri IS NULL) AS misses"
        " FROM ox_refs r LEFT JOIN fx_blob_index b ON b.uri = r.uri"),
    "ref_count": _with("SELECT count(*) AS ref_count FROM ox_resolved"),
    "sampled_refs": _with(
        "SELECT object_key, uri, size, file_id, blob_id, start, length FROM ox_resolved"
        " WHERE (file_id + start // 1024) % 100 < 1"),
    "archived_flag": _with("SELECT object_key, starts_with(object_key, 'archive/') AS archived FROM fx_objects"),
    "live_refs": _with(
        "SELECT object_key, uri, size, file_id, blob_id, start, length FROM ox_resolved"
        " WHERE NOT starts_with(object_key, 'archive/')"),
    "file_totals": _with("SELECT file_id, n_refs, n_live, remain_size, all_archived FROM ox_totals"),
    "file_paths": _with("SELECT file_id, path, n_refs, n_live, remain_size, all_archived FROM ox_paths"),
    "file_lengths": _with("SELECT file_id, path, length, all_archived FROM ox_lengths"),
    "file_outcomes": _with(
        "SELECT CASE WHEN f.file_id IS NULL THEN 'no_entry' WHEN f.path IS NULL THEN 'no_path'"
        " WHEN NOT t.all_archived AND l.length IS NULL THEN 'no_length' ELSE 'kept' END AS outcome,"
        " count(*) AS n_files, CAST(sum(t.n_refs) AS BIGINT) AS n_refs"
        " FROM ox_totals t LEFT JOIN fx_file_index f ON f.file_id = t.file_id"
        " LEFT JOIN fx_file_lengths l ON l.path = f.path GROUP BY 1"),
    "file_status": _with('SELECT file_id, "emptyPercent", "remainSize", path, deleted FROM ox_status'),
    "file_meta": _with('SELECT "meatRowKey", "objectKey", start, length FROM ox_meta'),
    "file_meta_lists": _with(
        'SELECT CAST(split_part("meatRowKey", \'_\', 1) AS BIGINT) AS file_id, count(*) AS n_meta,'
        ' CAST(coalesce(sum(length), 0) AS BIGINT) AS meta_length,'
        ' min("meatRowKey") AS first_key, max("meatRowKey") AS last_key FROM ox_meta GROUP BY 1'),
    "file_meta_numbered": _with(
        "SELECT file_id, list_no, count(*) AS n_rows,"
        " string_agg(concat(\"meatRowKey\", '=', \"objectKey\"), ',' ORDER BY place) AS listed FROM ox_listed GROUP BY file_id, list_no",
        LIST_CTES),
    "file_meta_flat": _with(
        'SELECT file_id, list_no, CAST(place AS INTEGER) AS place, "meatRowKey", "objectKey", start, length FROM ox_listed', LIST_CTES),
    "nested_objects": _with(
        "SELECT object_key, size, file_id, blob_id, start, length, concat('{\"file_id\":', file_id, ',\"blob_id\":\"', blob_id,"
        " '\",\"start\":', start, ',\"length\":', length, '}') AS nested FROM ox_resolved"),
    "status_roundtrip": _with('SELECT file_id, "emptyPercent", "remainSize", path, deleted FROM ox_status'),
    "status_row_count": _with("SELECT count(*) AS n_rows FROM ox_status"),
    "run_path_columns": _with("SELECT o_orderkey, status_path, meta_path FROM ox_run_paths", RUN_CTES),
    "run_catalog": _with(
        "SELECT o_orderkey, run_path,"
        " TRY_CAST(list_extract(string_split(rtrim(run_path, '/'), '/'), -2) AS BIGINT) AS run_ts"
        " FROM (SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN status_path"
        " WHEN 1 THEN concat(meta_path, '/')"
        " ELSE replace(status_path, '/file_status', '/latest/file_status') END AS run_path"
        " FROM ox_run_paths) r", RUN_CTES),
    "split_assignment": _with(
        "SELECT file_id, g AS pack_group, CAST(split_id AS INTEGER) AS split_id FROM ox_pack",
        SPLIT_CTES, recursive=True),
    "split_summary": _with(
        f"SELECT g AS pack_group, CAST(split_id AS INTEGER) AS split_id,"
        f" CAST(least(sum(CAST(remain AS HUGEINT)), {LONG_MAX}) AS BIGINT) AS size, count(*) AS n_files"
        f" FROM ox_pack GROUP BY g, split_id", SPLIT_CTES, recursive=True),
    "merged_tails": _with(
        "SELECT p.file_id, p.g AS pack_group, CAST(p.split_id AS INTEGER) AS split_id FROM ox_pack p"
        " WHERE NOT EXISTS (SELECT 1 FROM ox_tails t WHERE t.g = p.g AND t.split_id = p.split_id)"
        " UNION ALL SELECT file_id, g, CAST(split_id AS INTEGER) FROM ox_tail_pack",
        SPLIT_CTES, TAIL_CTES, recursive=True),
    "custom_cells": _with(
        "SELECT hex(encode(lpad(CAST(c_custkey AS VARCHAR), 9, '0'))) AS row_key_hex,"
        " hex(encode(CAST(c_custkey + 9007199254740993 AS VARCHAR))) AS value_hex"
        " FROM customer WHERE c_custkey % 7 <> 0"),
    "relocation_plan": _with(
        "SELECT p.g AS pack_group, CAST(p.split_id AS INTEGER) AS split_id, m.file_id, m.blob_id, m.start, m.length,"
        " CAST(coalesce(sum(m.length) OVER (PARTITION BY p.g, p.split_id ORDER BY m.file_id, m.start, m.blob_id"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS new_start"
        " FROM (SELECT DISTINCT CAST(split_part(\"meatRowKey\", '_', 1) AS BIGINT) AS file_id,"
        " substr(\"meatRowKey\", strpos(\"meatRowKey\", '_') + 1) AS blob_id, start, length FROM ox_meta) m"
        " JOIN ox_pack p ON p.file_id = m.file_id", SPLIT_CTES, recursive=True),
    "marked_deleted": _with(
        'SELECT file_id, "emptyPercent", "remainSize", path, ("emptyPercent" >= 90) AS deleted FROM ox_status'),
    "cells": _with(
        "SELECT hex(rk) AS row_key_hex, hex(fam) AS family_hex, hex(qual) AS qualifier_hex,"
        " hex(val) AS value_hex FROM ox_cells", CELL_CTES),
    "cell_labels": _with(
        "SELECT concat(decode(rk), ':', decode(fam), ':', decode(qual)) AS label FROM ox_cells", CELL_CTES),
    "run_instants": _with(
        "SELECT o_orderkey, strftime(make_timestamp(CAST(split_part(status_path, '/', 6) AS BIGINT) * 1000),"
        " '%Y-%m-%d %H:%M:%S.%g') AS run_at FROM ox_run_paths", RUN_CTES),
    "sorted_cells": _with(
        "SELECT row_number() OVER (ORDER BY rk, fam, qual) AS pos, hex(rk) AS row_key_hex,"
        " hex(fam) AS family_hex, hex(qual) AS qualifier_hex FROM ox_cells", CELL_CTES),
    "region_bucket": _with(
        "SELECT hex(rk) AS row_key_hex, hex(fam) AS family_hex, hex(qual) AS qualifier_hex,"
        " CAST(CASE WHEN rk >= encode('000001200') THEN 3 WHEN rk >= encode('000000700') THEN 2"
        " WHEN rk >= encode('000000300') THEN 1 ELSE 0 END AS INTEGER) AS region FROM ox_cells", CELL_CTES),
    "region_table": _with(
        "SELECT hex(rk) AS row_key_hex, hex(fam) AS family_hex, hex(qual) AS qualifier_hex, region FROM ox_regions",
        CELL_CTES, START_KEY_CTES),
    "table_splits": _with("SELECT file_id, CAST(split_id AS BIGINT) AS split_id FROM ox_fold", TABLE_SPLIT_CTES, recursive=True),
    "put_cells": _with(
        "SELECT hex(encode(lpad(CAST(o_orderkey AS VARCHAR), 10, '0'))) AS row_key_hex, hex(encode('o')) AS family_hex,"
        " hex(encode(q)) AS qualifier_hex, hex(encode(v)) AS value_hex FROM ("
        "SELECT o_orderkey, 'status' AS q, CAST(o_orderstatus AS VARCHAR) AS v FROM orders"
        " UNION ALL SELECT o_orderkey, 'customer', CAST(o_custkey AS VARCHAR) FROM orders) x WHERE v IS NOT NULL"),
    "bulk_load": _with(
        "SELECT region, count(*) AS n_cells, hex(min(rk)) AS first_hex, hex(max(rk)) AS last_hex,"
        " CAST(0 AS BIGINT) AS wrong_entries FROM ox_regions GROUP BY region", CELL_CTES, START_KEY_CTES),
    "hot_refs": _with(
        "SELECT b.uri, b.file_id, b.blob_id, count(*) AS n_refs, min(r.object_key) AS first_object, max(r.object_key) AS last_object"
        " FROM (SELECT object_key, uri FROM ox_refs UNION ALL"
        " SELECT object_key, concat(CAST(split_part(object_key, '/', 2) AS BIGINT) % 5 * 32 + 1, '-1') FROM fx_objects) r"
        " JOIN fx_blob_index b ON b.uri = r.uri GROUP BY 1, 2, 3"),
    "thinned_totals": _with("SELECT file_id, n_refs, n_live, remain_size, all_archived FROM ox_thin", THIN_CTES),
    "job_status": _with(
        'SELECT file_id, "emptyPercent", "remainSize", path, deleted, CAST(1505661514000 AS BIGINT) AS run_ts,'
        " '2017-09-17' AS day, CAST(2 AS BIGINT) AS n_outputs FROM ox_status"),
    "job_meta": _with(
        "SELECT concat(CAST(file_id AS VARCHAR), '_', blob_id) AS \"meatRowKey\", object_key AS \"objectKey\", start, length"
        " FROM ox_kept WHERE live AND file_id IN (SELECT file_id FROM ox_thin_files)", THIN_CTES),
    "job_counters": _with(
        "SELECT CAST(0 AS INTEGER) AS exit_code, (SELECT count(*) FROM ox_resolved) AS hits,"
        " (SELECT count(*) FROM ox_refs r WHERE NOT EXISTS (SELECT 1 FROM fx_blob_index b WHERE b.uri = r.uri)) AS misses,"
        " count(*) FILTER (WHERE f.path IS NOT NULL AND (t.all_archived OR l.length IS NOT NULL)) AS files,"
        " count(*) FILTER (WHERE f.file_id IS NULL) AS files_no_entry,"
        " count(*) FILTER (WHERE f.file_id IS NOT NULL AND f.path IS NULL) AS files_no_path,"
        " count(*) FILTER (WHERE f.path IS NOT NULL AND NOT t.all_archived AND l.length IS NULL) AS files_no_length"
        " FROM ox_totals t LEFT JOIN fx_file_index f ON f.file_id = t.file_id LEFT JOIN fx_file_lengths l ON l.path = f.path"),
    "listed_files": _with(
        "SELECT concat('d', file_id % 7, '/e', file_id % 3, '/f', file_id) AS file,"
        " CAST(CASE WHEN file_id % 9 = 4 THEN 0 ELSE count(*) END AS BIGINT) AS length FROM fx_blob_index GROUP BY file_id"),
}

# The relocation plan again, summed up by split in the order of the new file.
ORACLE_SQL["split_checks"] = ORACLE_SQL["relocation_plan"].replace("SELECT p.g AS pack_group", "SELECT pack_group, split_id,"
    " count(*) AS n_blobs, CAST(sum(length) AS BIGINT) AS new_bytes, CAST(0 AS BIGINT) AS holes,"
    " CAST(sum(n * length) AS BIGINT) AS ordered_sum, max_by(blob_id, n) AS last_blob FROM ("
    "SELECT *, row_number() OVER (PARTITION BY pack_group, split_id ORDER BY new_start, file_id, start, blob_id) AS n FROM ("
    "SELECT p.g AS pack_group", 1) + ") r) s GROUP BY pack_group, split_id"

# The compact job's splits: the merged tails, summed up by split.
ORACLE_SQL["job_splits"] = _with(
    f"SELECT pack_group, CAST(split_id AS INTEGER) AS split_id, CAST(least(sum(CAST(remain AS HUGEINT)), {LONG_MAX}) AS BIGINT) AS size,"
    " count(*) AS n_files, CAST(1505661514000 AS BIGINT) AS run_ts FROM ("
    "SELECT p.g AS pack_group, p.split_id, p.remain FROM ox_pack p"
    " WHERE NOT EXISTS (SELECT 1 FROM ox_tails t WHERE t.g = p.g AND t.split_id = p.split_id)"
    " UNION ALL SELECT g, split_id, remain FROM ox_tail_pack) s GROUP BY pack_group, split_id", SPLIT_CTES, TAIL_CTES, recursive=True)
