"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from ticketloom.fixed import LEAF_REMAP, TAXONOMY


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "[" + ", ".join(sql_text(i) for i in items) + "]"


def taxonomy_cte() -> str:
    leaves = [(l1, l2, l3, tags) for l1, l2, names, tags in TAXONOMY for l3 in names]
    rows = ",\n".join(
        f"({k}, {sql_text(l1)}, {sql_text(l2)}, {sql_text(l3)}, {sql_list(tags)})"
        for k, (l1, l2, l3, tags) in enumerate(leaves)
    )
    return (
        f"leaf(k, l1, l2, l3, pool) AS (VALUES {rows}),\n"
        "tax AS (SELECT *, l1 || ' > ' || l2 || ' > ' || l3 AS path FROM leaf)"
    )


def tickets_cte(name: str, source: str) -> str:
    """Ticket view over a subquery giving (i, text, lang, source)."""
    return f"""{name}_n AS ({source}),
{name}_a AS (
  SELECT n.*, t.l1, t.l2,
    CASE WHEN i % 31 = 0 THEN 'Excel Crash' ELSE t.l3 END AS l3x,
    CAST(1 + i % 5 AS INT) AS im,
    CAST(1 + CAST(floor(i / 5) AS BIGINT) % 5 AS INT) AS ur
  FROM {name}_n n JOIN tax t ON t.k = n.i % 48),
{name}_b AS (
  SELECT *, CAST(floor((im + ur + 1) / 2) AS INT) AS pr,
    [lower(l2), ' ' || lang || ' ', source, ''] AS tg,
    CAST(CASE WHEN i % 50 = 49 THEN i - 1 ELSE i END AS VARCHAR) AS idn
  FROM {name}_a),
{name} AS (
  SELECT i AS pos,
    'TCKT-' || lpad(idn, CAST(greatest(6, length(idn)) AS INT), '0') AS ticket_id,
    '2026-02-' || lpad(CAST(1 + i % 20 AS VARCHAR), 2, '0') || 'T' || lpad(CAST(i % 24 AS VARCHAR), 2, '0')
      || ':' || lpad(CAST(i % 60 AS VARCHAR), 2, '0') || ':00+02:00' AS created_at,
    CASE WHEN i % 41 = 0 THEN 'not-a-time' WHEN i % 37 = 0 THEN '2026-01-31T00:00:00+02:00'
      ELSE '2026-02-' || lpad(CAST(2 + i % 20 AS VARCHAR), 2, '0') || 'T12:00:00+02:00' END AS updated_at,
    CASE WHEN i % 29 = 0 THEN 'fax'
      ELSE (['email', 'portal', 'chatbot', 'phone'])[CAST(i % 4 AS INT) + 1] END AS channel,
    source AS model, lang AS dialect,
    split_part(text, chr(10), 1) AS title_ar, text AS description_ar,
    l1 AS category_level_1, l2 AS category_level_2, l3x AS category_level_3,
    l1 || ' > ' || l2 || ' > ' || l3x AS category_path,
    tg AS tags, {{'l1': l1, 'l2': l2, 'l3': l3x, 'tags': tg}} AS labels_json,
    im AS impact, ur AS urgency,
    CAST(CASE WHEN i % 23 = 0 THEN 9 WHEN i % 19 = 0 THEN pr % 5 + 1 ELSE pr END AS INT) AS priority,
    CASE WHEN i % 43 = 0 THEN 'angry'
      ELSE (['positive', 'neutral', 'negative', 'mixed'])[CAST(CAST(floor(i / 4) AS BIGINT) % 4 AS INT) + 1] END AS sentiment
  FROM {name}_b)"""


DOCUMENTS = "SELECT doc_id AS i, text, lang, source FROM documents"
TURNS = "SELECT conv_id * 1000 + turn AS i, text, 'chat' AS lang, role AS source FROM conversations"

WHITESPACE = "||".join(
    f"chr({n})"
    for n in [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760,
              *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)


def strip(text: str) -> str:
    return f"trim({text}, {WHITESPACE})"


def quoted(items) -> str:
    return ", ".join(sql_text(i) for i in items)


def codes_cte(name: str, tickets: str, json: bool = False, strict: bool = False) -> str:
    """Row codes, first accepted position and final reason of a ticket view.

    ``json`` adds the flaws planted in the raw-line form.
    """
    i = "t.pos"
    bad_int = f"({i} % 47 = 0 OR {i} % 79 = 0)" if json else "false"
    bad_tags = f"CASE WHEN {i} % 59 = 0 THEN 'bad:tags' END," if json else ""
    labels = (
        f"CASE WHEN {i} % 61 = 0 THEN 'bad:labels_json_type' "
        f"WHEN {i} % 67 = 0 AND {i} % 61 <> 0 THEN 'bad:labels_json_missing:l3' END,"
        if json
        else ""
    )
    ranges = ", ".join(
        (f"CASE WHEN {bad_int} THEN 'bad:type:impact' WHEN impact NOT BETWEEN 1 AND 5 THEN 'bad:range:impact' END"
         if k == "impact"
         else f"CASE WHEN {k} NOT BETWEEN 1 AND 5 THEN 'bad:range:{k}' END")
        for k in ("impact", "urgency", "priority")
    )
    strict_part = (
        ", CASE WHEN len(tags) NOT BETWEEN 2 AND 6 THEN 'strict:tag_count' END"
        ", CASE WHEN NOT regexp_matches(ticket_id, '^TCKT-\\d+(-\\d+)?$') THEN 'strict:ticket_id_format' END"
        ", CASE WHEN NOT (regexp_matches(created_at, '(Z|[+-]\\d{2}:\\d{2})$')"
        " AND regexp_matches(updated_at, '(Z|[+-]\\d{2}:\\d{2})$')) THEN 'strict:timestamp_zone' END"
        ", CASE WHEN labels_json.tags IS DISTINCT FROM tags THEN 'strict:labels_differ' END"
        if strict
        else ""
    )
    listed = f"""concat_ws(',',
      CASE WHEN channel NOT IN ('email','portal','chatbot','phone') THEN 'bad:channel' END,
      CASE WHEN sentiment NOT IN ('positive','neutral','negative','mixed') THEN 'bad:sentiment' END,
      {ranges},
      CASE WHEN try_cast(created_at AS TIMESTAMPTZ) IS NULL OR try_cast(updated_at AS TIMESTAMPTZ) IS NULL
        OR (length(created_at) = 10) <> (length(updated_at) = 10)
        THEN 'bad:timestamp'
        WHEN try_cast(updated_at AS TIMESTAMPTZ) < try_cast(created_at AS TIMESTAMPTZ) THEN 'bad:updated_at<created_at' END,
      CASE WHEN category_path IS DISTINCT FROM category_level_1 || ' > ' || category_level_2 || ' > ' || category_level_3
        THEN 'bad:category_path_mismatch' END,
      CASE WHEN x.path IS NULL THEN 'bad:category_not_allowed' END,
      {bad_tags} {labels}
      CASE WHEN NOT {bad_int} AND priority <> greatest(1, least(5, CAST(floor((impact + urgency + 1) / 2) AS INT)))
        THEN 'bad:priority_rule' END{strict_part})"""
    if json:
        listed = (
            f"CASE WHEN {i} % 71 = 0 THEN 'bad:json_parse' WHEN {i} % 73 = 0 THEN 'bad:not_object'"
            f" WHEN {i} % 53 = 0 THEN 'missing:model' ELSE {listed} END"
        )
    record = f"NOT ({i} % 71 = 0 OR {i} % 73 = 0)" if json else "true"
    return f"""{name}_c AS (
  SELECT t.*, {listed} AS codes, {record} AS is_record
  FROM {tickets} t LEFT JOIN tax x ON x.path = t.category_path),
{name}_f AS (
  SELECT ticket_id AS fid, min(pos) AS fp FROM {name}_c
  WHERE is_record AND codes IN ('', 'bad:priority_rule') GROUP BY 1),
{name}_r AS (
  SELECT c.*, concat_ws(',', nullif(codes, ''),
    CASE WHEN is_record AND pos > fp THEN 'bad:duplicate_ticket_id' END) AS all_codes
  FROM {name}_c c LEFT JOIN {name}_f ON fid = ticket_id),
{name} AS (
  SELECT *, all_codes = 'bad:priority_rule' AS autofix,
    CASE WHEN all_codes = 'bad:priority_rule' THEN '' ELSE all_codes END AS reason
  FROM {name}_r)"""


EXPECTED = "greatest(1, least(5, CAST(floor((impact + urgency + 1) / 2) AS INT)))"
CLEAN_TAGS = f"list_filter(list_transform(tags, lambda x: {strip('x')}), lambda x: x <> '')"
TAGS = "array_to_string(tags, '|') AS tags"
LABELS = (
    "concat_ws('|', labels_json.l1, labels_json.l2, labels_json.l3,"
    " array_to_string(labels_json.tags, ';')) AS labels_json"
)
COLUMNS = [
    "ticket_id", "created_at", "updated_at", "channel", "model", "dialect", "title_ar",
    "description_ar", "category_level_1", "category_level_2", "category_level_3",
    "category_path", "tags", "labels_json", "impact", "urgency", "priority", "sentiment",
]


def flat_columns(pos: bool = True, **changed: str) -> str:
    shown = {"tags": TAGS, "labels_json": LABELS} | {k: f"{v} AS {k}" for k, v in changed.items()}
    return ", ".join((["pos"] if pos else []) + [shown.get(c, c) for c in COLUMNS])


def documents_view() -> str:
    return tickets_cte("tickets", DOCUMENTS)


def both_views() -> str:
    union = "everything AS (SELECT * FROM tickets UNION ALL SELECT * FROM turn_tickets)"
    return ",\n".join([documents_view(), tickets_cte("turn_tickets", TURNS), union])


def on_tickets(select: str) -> str:
    return f"WITH {taxonomy_cte()},\n{documents_view()}\n{select}"


def on_everything(select: str) -> str:
    return f"WITH {taxonomy_cte()},\n{both_views()}\n{select}"


def on_validated(select: str) -> str:
    return f"WITH {taxonomy_cte()},\n{documents_view()},\n{codes_cte('val', 'tickets')}\n{select}"


def on_json(select: str) -> str:
    planted = """planted AS (SELECT * REPLACE (
    CASE WHEN pos % 83 = 0 THEN 'Service > Incident > Outage' ELSE category_path END AS category_path,
    CASE WHEN pos % 89 = 0 THEN 7 ELSE urgency END AS urgency) FROM tickets)"""
    codes = codes_cte("val", "planted", json=True)
    return f"WITH {taxonomy_cte()},\n{documents_view()},\n{planted},\n{codes}\n{select}"


ORACLE: dict[str, str] = {}

# --- validation --------------------------------------------------------------

ORACLE["validate_codes"] = on_validated(
    "SELECT code, count(*) AS n FROM (SELECT unnest(string_split(codes, ',')) AS code FROM val_c WHERE codes <> '') GROUP BY 1"
)
ORACLE["validate_reasons"] = on_validated("SELECT pos, ticket_id, reason FROM val")
CLEAN_PRIORITY = f"CASE WHEN autofix THEN {EXPECTED} ELSE priority END"
ORACLE["clean_rows"] = on_validated(
    "SELECT "
    + flat_columns(priority=CLEAN_PRIORITY, tags=f"array_to_string({CLEAN_TAGS}, '|')")
    + " FROM val WHERE reason = ''"
)
ORACLE["rejected_rows"] = on_validated(
    "SELECT pos, ticket_id, description_ar, priority, reason FROM val WHERE reason <> ''"
)
ORACLE["autofixed_priority"] = on_validated(
    f"SELECT pos, ticket_id, {EXPECTED} AS priority, priority AS old_priority FROM val WHERE autofix"
)
ORACLE["duplicate_ids"] = on_validated(
    "SELECT pos, ticket_id FROM val WHERE all_codes LIKE '%bad:duplicate_ticket_id'"
)
ORACLE["run_summary"] = on_validated(
    "SELECT count(*) AS n_rows, count(*) FILTER (reason = '') AS n_clean,"
    " count(*) FILTER (reason <> '') AS n_rejected, count(*) FILTER (autofix) AS n_autofixed FROM val"
)
ORACLE["rejected_listing"] = on_validated(
    "SELECT coalesce(nullif(ticket_id, ''), 'documents:' || pos) AS row_id,"
    " replace(reason, ',', ', ') AS causes FROM val WHERE reason <> ''"
)
STRICT_VIEW = """odd AS (SELECT * REPLACE (tags[1:CAST(1 + pos % 4 AS INT)] AS tags,
    CASE WHEN pos % 17 = 0 THEN replace(ticket_id, '-', '_') ELSE ticket_id END AS ticket_id,
    CASE WHEN pos % 13 = 0 THEN split_part(created_at, 'T', 1) ELSE created_at END AS created_at) FROM tickets)"""
ORACLE["strict_contract"] = (
    f"WITH {taxonomy_cte()},\n{documents_view()},\n{STRICT_VIEW},\n"
    + codes_cte("val", "odd", strict=True)
    + "\nSELECT pos, ticket_id, reason FROM val"
)
ORACLE["canonical_columns"] = on_everything(f"SELECT {flat_columns(pos=False)} FROM everything")
ORACLE["preview_head"] = on_tickets(f"SELECT {flat_columns()} FROM tickets ORDER BY pos LIMIT 5")
ORACLE["taxonomy_coverage"] = on_everything(
    "SELECT k, l1, l2, l3, path, array_to_string(pool, ',') AS tags, count(e.pos) AS n"
    " FROM tax LEFT JOIN everything e ON e.category_path = path GROUP BY ALL"
)
ORACLE["allowed_paths_used"] = on_tickets(
    "SELECT path FROM tax WHERE path IN (SELECT category_path FROM tickets)"
)

# --- raw JSON lines ----------------------------------------------------------

ORACLE["json_reasons"] = on_json(
    "SELECT pos, CASE WHEN is_record THEN ticket_id END AS ticket_id, pos % 71 <> 0 AS parse_ok, reason FROM val"
)
ORACLE["json_clean_rows"] = on_json(
    "SELECT "
    + flat_columns(pos=False, priority=CLEAN_PRIORITY, tags=f"array_to_string({CLEAN_TAGS}, '|')")
    + " FROM val WHERE reason = ''"
)


def violations_sql(rows: str, missing: str = "false", given: str = "priority", record: str = "true") -> str:
    """Violation counts; ``rows`` gives impact, urgency and levels as read."""
    calc = "greatest(1, least(5, CAST(floor((impact + urgency + 1) / 2) AS INT)))"
    return f"""q AS (SELECT t.*, x.path AS known, {record} AS rec FROM {rows} t
    LEFT JOIN tax x ON x.l1 = category_level_1 AND x.l2 = category_level_2 AND x.l3 = category_level_3),
  vio AS (SELECT count(*) AS total,
    count(*) FILTER (rec AND {missing}) AS missing_keys,
    count(*) FILTER (rec AND channel NOT IN ('email','portal','chatbot','phone')) AS bad_channel,
    count(*) FILTER (rec AND sentiment NOT IN ('positive','neutral','negative','mixed')) AS bad_sentiment,
    count(*) FILTER (rec AND {given} IS DISTINCT FROM {calc}) AS bad_priority,
    count(*) FILTER (rec AND known IS NULL) AS bad_taxonomy,
    count(*) FILTER (rec AND category_path IS DISTINCT FROM
      category_level_1 || ' > ' || category_level_2 || ' > ' || category_level_3) AS bad_category_path
    FROM q),
  vio_long AS (SELECT metric, n, round(100.0 * n / (SELECT total FROM vio), 2) AS pct
    FROM vio UNPIVOT (n FOR metric IN (total, missing_keys, bad_channel, bad_sentiment, bad_priority, bad_taxonomy, bad_category_path)))"""


# a planted text "3" and 3.0 both read as 3
ORACLE["json_quality"] = on_json(
    "SELECT metric, n, pct FROM vio_long"
).replace(
    "\nSELECT metric",
    ",\nread AS (SELECT * REPLACE (CASE WHEN pos % 47 = 0 OR pos % 79 = 0 THEN 3 ELSE impact END AS impact) FROM val_c),\n"
    + violations_sql("read", missing="pos % 53 = 0", record="is_record")
    + "\nSELECT metric",
)
ORACLE["json_reject_listing"] = on_json(
    "SELECT 'documents' AS source, pos AS line, reason,"
    " CASE WHEN is_record THEN description_ar END AS description_ar, pos % 71 = 0 AS has_raw"
    " FROM val WHERE reason <> ''"
)
ORACLE["parse_props"] = (
    "SELECT event_id, json_valid(props) AS parse_ok, array_to_string(list_sort(json_keys(props)), ',') AS keys,"
    " CAST(props->>'$.k' AS BIGINT) AS k FROM events"
)

# --- files -------------------------------------------------------------------

ORACLE["scan_line_numbers"] = (
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS files_off, CAST(0 AS BIGINT) AS pairs_off FROM documents"
)
ORACLE["csv_roundtrip"] = on_everything(
    "SELECT "
    + ", ".join(f"CAST(to_json({c}) AS VARCHAR) AS {c}" if c in ("tags", "labels_json") else c for c in COLUMNS)
    + " FROM everything"
)
ORACLE["jsonl_roundtrip"] = on_everything(f"SELECT {flat_columns(pos=False)} FROM everything")

# --- fix merge and repair ----------------------------------------------------

FIX_VIEWS = """parts AS (
  SELECT 'part_' || lang || '.jsonl' AS part, doc_id AS line,
    CASE WHEN doc_id % 13 <> 0 THEN
      'TCKT-' || lpad(CAST(doc_id - doc_id % 12 AS VARCHAR), CAST(greatest(6, length(CAST(doc_id - doc_id % 12 AS VARCHAR))) AS INT), '0') END AS id_key,
    text, source AS origin FROM documents),
fixes AS (
  SELECT CASE role WHEN 'user' THEN 'part_en' WHEN 'assistant' THEN 'part_fr' ELSE 'part_other' END AS stem,
    conv_id * 1000 + turn AS line,
    CASE WHEN turn <> 3 THEN
      'TCKT-' || lpad(CAST(conv_id AS VARCHAR), CAST(greatest(6, length(CAST(conv_id AS VARCHAR))) AS INT), '0') END AS id_key,
    text, role AS origin FROM conversations)"""
ORACLE["fix_merge"] = f"""WITH {FIX_VIEWS},
latest AS (
  SELECT stem || '.jsonl' AS part, id_key, min(line) AS first_line, arg_max(text, line) AS text, arg_max(origin, line) AS origin
  FROM fixes WHERE id_key IS NOT NULL AND stem || '.jsonl' IN (SELECT part FROM parts) GROUP BY ALL),
targets AS (SELECT p.part, p.id_key, min(p.line) AS line FROM parts p JOIN latest l USING (part, id_key) GROUP BY ALL),
ends AS (SELECT part, max(line) AS last_line FROM parts GROUP BY 1)
SELECT p.part, p.line, coalesce(l.text, p.text) AS text, coalesce(l.origin, p.origin) AS origin, l.part IS NOT NULL AS is_fix
FROM parts p LEFT JOIN targets t ON t.part = p.part AND t.line = p.line
LEFT JOIN latest l ON l.part = t.part AND l.id_key = t.id_key
UNION ALL
SELECT l.part, last_line + first_line, l.text, l.origin, true
FROM latest l JOIN ends USING (part)
WHERE NOT EXISTS (SELECT 1 FROM targets t WHERE t.part = l.part AND t.id_key = l.id_key)"""
ORACLE["fix_version"] = f"SELECT part, line, text, origin FROM ({ORACLE['fix_merge']})"
ORACLE["fix_orphans"] = f"""WITH {FIX_VIEWS}
SELECT stem || '_fixed.jsonl' AS part, line, id_key, origin FROM fixes
WHERE stem || '.jsonl' NOT IN (SELECT part FROM parts)"""


def closest_sql(value: str, allowed: list[str]) -> str:
    pairs = ", ".join(
        f"{{'d': levenshtein(lower({strip(value)}), {sql_text(a)}), 'v': {sql_text(a)}}}" for a in allowed
    )
    return f"CASE WHEN {value} IN ({quoted(allowed)}) THEN {value} ELSE list_min([{pairs}]).v END"


def repair_cte(source: str) -> str:
    """Repaired rows of a typed view; nulls mark missing fields."""
    return f"""r0 AS (SELECT s.*, x.path AS level_path,
    coalesce(category_path, concat_ws(' > ', category_level_1, category_level_2, category_level_3)) AS given_path
  FROM {source} s LEFT JOIN tax x ON x.l1 = category_level_1 AND x.l2 = category_level_2 AND x.l3 = category_level_3),
bad AS (SELECT DISTINCT given_path FROM r0 WHERE level_path IS NULL),
near AS (SELECT given_path, (SELECT list_min(list({{'d': levenshtein(given_path, path), 'p': path}})) FROM tax).p AS near_path FROM bad),
r1 AS (SELECT r0.*, coalesce(level_path, near_path) AS new_path,
    CASE WHEN try_cast(created_at AS TIMESTAMPTZ) IS NOT NULL THEN created_at END AS c_ok,
    CASE WHEN try_cast(updated_at AS TIMESTAMPTZ) IS NOT NULL THEN updated_at END AS u_ok
  FROM r0 LEFT JOIN near USING (given_path)),
r2 AS (SELECT r1.*, x.l1 AS n1, x.l2 AS n2, x.l3 AS n3, x.pool,
    coalesce(c_ok, u_ok, '2026-02-01T00:00:00+00:00') AS start,
    greatest(1, least(5, coalesce(impact, 3))) AS im2, greatest(1, least(5, coalesce(urgency, 3))) AS ur2,
    coalesce({CLEAN_TAGS}, []) AS given_tags
  FROM r1 JOIN tax x ON x.path = new_path),
r3 AS (SELECT *, CASE WHEN len(given_tags) >= 2 THEN given_tags[1:6]
    ELSE list_concat(given_tags, list_filter(pool, lambda x: NOT list_contains(given_tags, x)))[1:2] END AS tags2 FROM r2),
rep AS (SELECT pos AS line, ticket_id, start AS created_at,
    CASE WHEN CAST(u_ok AS TIMESTAMPTZ) >= CAST(start AS TIMESTAMPTZ) THEN u_ok ELSE start END AS updated_at,
    CASE WHEN channel IS NULL THEN 'portal' ELSE {closest_sql('channel', ['email', 'portal', 'chatbot', 'phone'])} END AS channel,
    coalesce(model, 'unknown') AS model, coalesce(dialect, 'Egyptian') AS dialect,
    coalesce(title_ar, '') AS title_ar, coalesce(description_ar, '') AS description_ar,
    n1 AS category_level_1, n2 AS category_level_2, n3 AS category_level_3, new_path AS category_path,
    tags2 AS tags, {{'l1': n1, 'l2': n2, 'l3': n3, 'tags': tags2}} AS labels_json,
    im2 AS impact, ur2 AS urgency, CAST(greatest(1, least(5, floor((im2 + ur2 + 1) / 2))) AS INT) AS priority,
    CASE WHEN sentiment IS NULL THEN 'neutral' ELSE {closest_sql('sentiment', ['positive', 'neutral', 'negative', 'mixed'])} END AS sentiment
  FROM r3)"""


REPAIRED = f"SELECT 'documents' AS source, line, {flat_columns(pos=False)} FROM rep"
ORACLE["repair_rules"] = on_validated(REPAIRED).replace(
    "\n" + REPAIRED, ",\nrejected AS (SELECT * FROM val WHERE reason <> ''),\n" + repair_cte("rejected") + "\n" + REPAIRED
)
# repaired rows have only their ids left to fail on: within rejects, the first of an id stands
REVALIDATED = """SELECT CASE WHEN line > min(line) OVER (PARTITION BY ticket_id)
  THEN 'bad:duplicate_ticket_id' ELSE '' END AS reason, line FROM rep"""
ORACLE["repair_revalidated"] = on_validated("SELECT 1").replace(
    "\nSELECT 1",
    ",\nrejected AS (SELECT * FROM val WHERE reason <> ''),\n"
    + repair_cte("rejected")
    + f"\nSELECT reason, count(*) AS n FROM ({REVALIDATED}) GROUP BY 1",
)
READ_JSON = """given AS (SELECT pos,
    CASE WHEN is_record THEN ticket_id ELSE 'TCKT-' || CAST(('0x' || substr(sha256('documents:' || pos), 1, 15))::BIGINT AS VARCHAR) END AS ticket_id,
    CASE WHEN is_record THEN created_at END AS created_at, CASE WHEN is_record THEN updated_at END AS updated_at,
    CASE WHEN is_record THEN channel END AS channel, CASE WHEN is_record THEN sentiment END AS sentiment,
    CASE WHEN is_record AND pos % 53 <> 0 THEN model END AS model, CASE WHEN is_record THEN dialect END AS dialect,
    CASE WHEN is_record THEN title_ar END AS title_ar, CASE WHEN is_record THEN description_ar END AS description_ar,
    CASE WHEN is_record THEN category_level_1 END AS category_level_1,
    CASE WHEN is_record THEN category_level_2 END AS category_level_2,
    CASE WHEN is_record THEN category_level_3 END AS category_level_3,
    CASE WHEN is_record THEN category_path END AS category_path,
    CASE WHEN NOT is_record THEN NULL WHEN pos % 59 = 0 THEN ['a', '1'] ELSE tags END AS tags,
    CASE WHEN NOT is_record THEN NULL WHEN pos % 47 = 0 OR pos % 79 = 0 THEN 3 ELSE impact END AS impact,
    CASE WHEN is_record THEN urgency END AS urgency
  FROM val WHERE reason <> '')"""
ORACLE["repair_json_rejects"] = on_json(REPAIRED).replace(
    "\n" + REPAIRED, ",\n" + READ_JSON + ",\n" + repair_cte("given") + "\n" + REPAIRED
)

ORACLE["repair_free_ids"] = on_json(
    "SELECT pos AS line, CASE WHEN is_record THEN ticket_id ELSE 'TCKT-' || CAST(('0x' || substr(sha256('documents:' || pos"
    " || CASE WHEN pos % 4 = 0 THEN '#2' WHEN pos % 2 = 0 THEN '#1' ELSE '' END), 1, 15))::BIGINT AS VARCHAR) END AS ticket_id"
    " FROM val WHERE reason <> ''"
)

# --- quality report ----------------------------------------------------------

ORACLE["dq_violations"] = on_tickets("SELECT metric, n, pct FROM vio_long").replace(
    "\nSELECT metric", ",\n" + violations_sql("tickets") + "\nSELECT metric"
)
MISMATCHES = f"""SELECT pos, ticket_id, impact, urgency, priority, {EXPECTED} AS expected
FROM tickets WHERE priority <> {EXPECTED} ORDER BY pos LIMIT 10"""
UNKNOWN = """SELECT pos, ticket_id, category_level_1, category_level_2, category_level_3
FROM tickets WHERE category_path NOT IN (SELECT path FROM tax) ORDER BY pos LIMIT 10"""
ORACLE["dq_first10_priority"] = on_tickets(MISMATCHES)
ORACLE["dq_first10_taxonomy"] = on_tickets(UNKNOWN)


def lengths_sql(view: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS field, CAST(min(length({f})) AS INT) AS min, CAST(max(length({f})) AS INT) AS max,"
        f" round(avg(length({f})), 4) AS mean, round(median(length({f})), 4) AS median FROM {view}"
        for f in ("title_ar", "description_ar")
    )


ORACLE["dq_lengths"] = on_everything(lengths_sql("everything"))


def top_sql(view: str, keys: dict[str, str]) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, {key} AS key, count(*) AS n FROM {view} GROUP BY 2"
        for name, key in keys.items()
    )
    return f"""SELECT table_name, key, n, CAST(rank AS INT) AS rank FROM (SELECT *,
      row_number() OVER (PARTITION BY table_name ORDER BY n DESC, key) AS rank FROM ({counts})) WHERE rank <= 10"""


HIERARCHY = {
    "l1": "category_level_1",
    "l2": "category_level_1 || ' > ' || category_level_2",
    "l3": "category_level_1 || ' > ' || category_level_2 || ' > ' || category_level_3",
}
SCALARS = {
    "channel": "channel",
    "sentiment": "sentiment",
    "impact": "CAST(impact AS VARCHAR)",
    "urgency": "CAST(urgency AS VARCHAR)",
    "priority": "CAST(priority AS VARCHAR)",
}
ORACLE["dq_top10_hier"] = on_everything(top_sql("everything", HIERARCHY))
ORACLE["dq_top10_scalar"] = on_everything(top_sql("everything", SCALARS))


def groups_sql(view: str, title: str, text: str) -> str:
    return f"SELECT {title} AS k1, {text} AS k2, count(*) AS n, min(pos) AS first_pos FROM {view} GROUP BY 1, 2"


STRIPPED = (strip("title_ar"), strip("description_ar"))
ORACLE["dq_duplicates"] = on_everything(
    "SELECT count(*) FILTER (n > 1) AS dup_groups, CAST(sum(n - 1) AS BIGINT) AS dup_records"
    f" FROM ({groups_sql('everything', *STRIPPED)})"
)

HEADINGS = {
    100: "== Violations ==", 150: "",
    200: "First 10 priority mismatches (ticket, impact, urgency, priority, expected):",
    300: "First 10 taxonomy violations (ticket, L1,L2,L3):", 350: "",
    400: "== Lengths (chars) ==", 450: "", 500: "== Distributions ==",
    600: "Top L1:", 700: "Top L2 (by L1,L2):", 800: "Top L3 (by L1,L2,L3):", 900: "Channels:",
    1000: "Sentiment:", 1100: "Impact:", 1200: "Urgency:", 1300: "Priority:",
    2000: "", 2001: "== Duplicates ==",
}
VIOLATION_TITLES = [
    ("missing_keys", "Missing required keys"),
    ("bad_channel", "Bad channel"),
    ("bad_sentiment", "Bad sentiment"),
    ("bad_priority", "Priority rule mismatches"),
    ("bad_taxonomy", "Taxonomy (L1/L2/L3) not allowed"),
    ("bad_category_path", "category_path mismatch"),
]


def report_sql() -> str:
    fixed = " UNION ALL ".join(f"SELECT {o} AS ord, {sql_text(t)} AS text" for o, t in HEADINGS.items())
    violations = " UNION ALL ".join(
        f"SELECT {101 + n}, printf('{title}: %d (%.2f%%)', n, pct) FROM vio_long WHERE metric = '{metric}'"
        for n, (metric, title) in enumerate(VIOLATION_TITLES)
    )
    sizes = " UNION ALL ".join(
        f"SELECT {o}, printf('{label}: mean %.1f, median %.1f, min %d, max %d', avg(length({f})), median(length({f})),"
        f" min(length({f})), max(length({f}))) FROM tickets"
        for o, label, f in ((401, "Description len", "description_ar"), (402, "Title len", "title_ar"))
    )
    tables = {**HIERARCHY, **SCALARS}
    place = " ".join(f"WHEN '{t}' THEN {600 + 100 * n}" for n, t in enumerate(tables))
    return f"""{fixed}
UNION ALL SELECT 0, printf('Total: %d', n) FROM vio_long WHERE metric = 'total'
UNION ALL {violations}
UNION ALL SELECT 200 + row_number() OVER (ORDER BY pos),
  printf('(''%s'', %d, %d, %d, %d)', ticket_id, impact, urgency, priority, expected) FROM ({MISMATCHES})
UNION ALL SELECT 300 + row_number() OVER (ORDER BY pos),
  printf('(''%s'', ''%s'', ''%s'', ''%s'')', ticket_id, category_level_1, category_level_2, category_level_3) FROM ({UNKNOWN})
UNION ALL {sizes}
UNION ALL SELECT CASE table_name {place} END + rank, printf('%s: %d', key, n) FROM ({top_sql('tickets', tables)})
UNION ALL SELECT 2002, printf('Duplicate (exact title+description) pairs: %d', count(*) FILTER (n > 1))
  FROM ({groups_sql('tickets', *STRIPPED)})
UNION ALL SELECT 2003, printf('Duplicate extra records (beyond first): %d', CAST(sum(n - 1) AS BIGINT))
  FROM ({groups_sql('tickets', *STRIPPED)})"""


ORACLE["dq_report_text"] = on_tickets("SELECT 1").replace(
    "\nSELECT 1",
    ",\n" + violations_sql("tickets") + f"\nSELECT CAST(ord AS INT) AS ord, text FROM ({report_sql()})",
)

# --- duplicates --------------------------------------------------------------

ORACLE["duplicate_groups"] = on_tickets(
    f"SELECT first_pos, n AS copies FROM ({groups_sql('tickets', *STRIPPED)}) WHERE n > 1"
)
ORACLE["drop_duplicates_first"] = on_tickets(
    "SELECT pos, ticket_id, title_ar, description_ar FROM tickets"
    f" WHERE pos IN (SELECT first_pos FROM ({groups_sql('tickets', 'title_ar', 'description_ar')}))"
)


def hex_number(digest: str, index: int = 0) -> str:
    return f"CAST('0x' || substr({digest}, {1 + 15 * index}, 15) AS BIGINT)"


def digits(number: str, sizes: list[int]) -> list[str]:
    picks, used = [], 1
    for size in sizes:
        picks.append(f"(({number}) // {used} % {size})")
        used *= size
    return picks


def chosen(items, pick: str) -> str:
    return f"({sql_list(items)})[CAST({pick} AS INT) + 1]"


def digest_sql(mode: str) -> str:
    if mode == "spread":
        return "md5(ticket_id)"
    total = "list_sum(list_transform(string_split(ticket_id, ''), lambda c: unicode(c)))"
    return f"md5(CAST(CAST({total} AS BIGINT) AS VARCHAR))"


def varied_cte(mode: str) -> str:
    from ticketloom.fixed import OPERATING_SYSTEMS, REPEAT_SENTENCES, REPEAT_STAMP

    remark, hour, minute, floor, system = digits(hex_number(digest_sql(mode)), [4, 24, 60, 6, 4])
    stamp = (
        f"printf({sql_text(REPEAT_STAMP)}, lpad(CAST({hour} AS VARCHAR), 2, '0'),"
        f" lpad(CAST({minute} AS VARCHAR), 2, '0'), {floor} + 1, {chosen(OPERATING_SYSTEMS, system)})"
    )
    dotted = "CASE WHEN description_ar LIKE '%.' THEN description_ar ELSE description_ar || '.' END"
    return f"""grp AS ({groups_sql('tickets', *STRIPPED)}),
varied AS (SELECT t.* REPLACE (CASE WHEN pos > first_pos
    THEN {dotted} || ' ' || {chosen(REPEAT_SENTENCES, remark)} || ' ' || {stamp} ELSE description_ar END AS description_ar)
  FROM tickets t JOIN grp ON k1 = {STRIPPED[0]} AND k2 = {STRIPPED[1]})"""


def on_varied(mode: str, select: str) -> str:
    return f"WITH {taxonomy_cte()},\n{documents_view()},\n{varied_cte(mode)}\n{select}"


ORACLE["vary_duplicates"] = on_varied("spread", "SELECT pos, ticket_id, description_ar FROM varied")
ORACLE["vary_duplicates_by_sum"] = on_varied("sum", "SELECT pos, ticket_id, description_ar FROM varied")
ORACLE["residual_duplicates"] = on_varied(
    "spread",
    "SELECT count(*) FILTER (n > 1) AS dup_groups, CAST(sum(n - 1) AS BIGINT) AS dup_records,"
    f" round(100.0 * sum(n - 1) / sum(n), 4) AS pct FROM ({groups_sql('varied', *STRIPPED)})",
)

NUMBERED = on_tickets("SELECT pos, ticket_id, description_ar FROM varied").replace(
    "\nSELECT pos",
    ",\n" + varied_cte("spread")
    .replace(hex_number(digest_sql("spread")), "((copy_no - 1) % 138240 * 39119 % 138240)")
    .replace("CASE WHEN pos > first_pos", "CASE WHEN copy_no > 0")
    .replace(
        "FROM tickets t JOIN grp ON",
        f"FROM (SELECT *, row_number() OVER (PARTITION BY {STRIPPED[0]}, {STRIPPED[1]} ORDER BY pos) - 1 AS copy_no FROM tickets) t JOIN grp ON",
    ).replace("SELECT t.* REPLACE", "SELECT t.* EXCLUDE (copy_no) REPLACE")
    + "\nSELECT pos",
)
ORACLE["vary_duplicates_numbered"] = NUMBERED
ORACLE["residual_numbered"] = NUMBERED.replace(
    "\nSELECT pos, ticket_id, description_ar FROM varied",
    "\nSELECT count(*) FILTER (n > 1) AS dup_groups, CAST(sum(n - 1) AS BIGINT) AS dup_records,"
    f" round(100.0 * sum(n - 1) / sum(n), 4) AS pct FROM ({groups_sql('varied', *STRIPPED)})",
)

# --- post-processing ---------------------------------------------------------


def remap_cte() -> str:
    rows = ", ".join("(" + quoted(old + new) + ")" for old, new in LEAF_REMAP)
    return f"""remap(o1, o2, o3, m1, m2, m3) AS (VALUES {rows}),
mapped AS (SELECT e.* REPLACE (
    coalesce(m1, category_level_1) AS category_level_1, coalesce(m2, category_level_2) AS category_level_2,
    coalesce(m3, category_level_3) AS category_level_3,
    CASE WHEN m3 IS NULL THEN category_path ELSE m1 || ' > ' || m2 || ' > ' || m3 END AS category_path,
    CASE WHEN m3 IS NULL THEN labels_json ELSE {{'l1': m1, 'l2': m2, 'l3': m3, 'tags': tags}} END AS labels_json)
  FROM everything e LEFT JOIN remap ON o1 = category_level_1 AND o2 = category_level_2 AND o3 = category_level_3)"""


def on_mapped(select: str) -> str:
    return f"WITH {taxonomy_cte()},\n{both_views()},\n{remap_cte()}\n{select}"


ORACLE["postprocess_remap"] = on_mapped(
    f"SELECT pos, ticket_id, category_level_1, category_level_2, category_level_3, category_path, {LABELS}, {TAGS} FROM mapped"
)
ORACLE["postprocess_priority"] = on_everything(
    f"SELECT pos, ticket_id, impact, urgency, {EXPECTED} AS priority FROM everything"
)


def enriched_sql() -> str:
    from ticketloom import fixed

    digest = digest_sql("spread")
    system, error, version, code, ssid, floor, signal = digits(hex_number(digest), [4, 4, 4, 4, 4, 6, 3])
    hours, tone, more = digits(hex_number(digest, 1), [48, 4, 3])
    system, version = chosen(fixed.OPERATING_SYSTEMS, system), chosen(fixed.OFFICE_VERSIONS, version)
    l2 = "category_level_1 = '{}' AND category_level_2 = '{}'"
    outlook = l2.format("Software", "Email/Calendar") + " AND category_level_3 = 'Outlook Issue'"

    def said(pattern: str, *values: str) -> str:
        return f"printf({', '.join([sql_text(pattern), *values])})"

    sentences = [
        (l2.format("Network", "VPN"), said(fixed.VPN_SENTENCE, system, chosen(fixed.VPN_ERRORS, error))),
        (outlook, said(fixed.OUTLOOK_VERSION_SENTENCE, system, version)),
        (outlook, sql_text(fixed.OUTLOOK_PROFILE_SENTENCE)),
        (outlook, said(fixed.OUTLOOK_CODE_SENTENCE, chosen(fixed.OUTLOOK_ERRORS, code))),
        (l2.format("Network", "WiFi"), said(fixed.WIFI_SENTENCE, chosen(fixed.WIFI_SSIDS, ssid),
                                            f"{floor} + 1", chosen(fixed.WIFI_SIGNALS, signal))),
        (l2.format("Hardware", "Laptop/Desktop") + " AND category_level_3 = 'Performance'",
         said(fixed.PERFORMANCE_SENTENCE, system)),
        (l2.format("Software", "Office Apps"), said(fixed.OFFICE_SENTENCE, version)),
        ("true", said(fixed.AGE_SENTENCE, f"{hours} + 1")),
        ("true", chosen(fixed.TONE_SENTENCES, tone)),
    ]
    listed = ", ".join(f"CASE WHEN {fits} THEN {text} END" for fits, text in sentences)
    extra = f"list_filter([{listed}], lambda x: x IS NOT NULL)[1:CAST({more} + 2 AS INT)]"
    base = "[regexp_replace(description_ar, '\\.+$', '')]"
    dotted = f"list_transform(list_concat({base}, {extra}), lambda x: CASE WHEN x LIKE '%.' THEN x ELSE x || '.' END)"
    text = f"CASE WHEN length(description_ar) < 90 THEN array_to_string({dotted}, ' ') ELSE description_ar END"
    return f"SELECT {flat_columns(description_ar=text, priority=EXPECTED)} FROM mapped"


ORACLE["postprocess_enrich"] = on_mapped(enriched_sql())

# --- synthesis ---------------------------------------------------------------


def synth_cte() -> str:
    from ticketloom import fixed

    descs = {row[:3]: row[3] for row in fixed.DESCRIPTIONS}
    texts = ",\n".join(
        f"({quoted(row[:3])}, {sql_list(row[3])}, {sql_list(descs[row[:3]]) if row[:3] in descs else 'NULL'})"
        for row in fixed.TITLES
    )
    n0, n1, n2, n3 = (f"d{n}" for n in range(4))
    leaf, day, hour, minute, hours, minutes = digits(n0, [48, 20, 24, 60, 73, 60])
    impact, urgency, channel, sentiment, n_tags = digits(n1, [5, 5, 4, 4, 5])
    generic = sql_list([fixed.GENERIC_DESCRIPTION_AGE])
    any_desc = f"list_concat([printf({sql_text(fixed.GENERIC_DESCRIPTION_CATEGORY)}, l1, l2, l3)], {generic})"
    iso = "strftime({}, '%Y-%m-%dT%H:%M:%S') || '+02:00'"
    created = f"make_timestamp(2026, 2, 1 + {day}, {hour}, {minute}, 0)"
    updated = f"{created} + to_hours(CAST({hours} AS INT)) + to_minutes(CAST({minutes} AS INT))"
    return f"""texts(t1, t2, t3, titles, descs) AS (VALUES {texts}),
s0 AS (SELECT doc_id + 1 AS seq, sha256('42:' || (doc_id + 1)) AS h FROM documents),
s1 AS (SELECT *, {", ".join(f"{hex_number('h', n)} AS d{n}" for n in range(4))} FROM s0),
s2 AS (SELECT s1.*, tax.*, titles, coalesce(descs, {any_desc}) AS descs FROM s1
  JOIN tax ON tax.k = {leaf} JOIN texts ON t1 = l1 AND t2 = l2 AND t3 = l3),
synth AS (SELECT seq AS pos,
  'TCKT-001-' || lpad(CAST(seq AS VARCHAR), CAST(greatest(3, length(CAST(seq AS VARCHAR))) AS INT), '0') AS ticket_id,
  {iso.format(created)} AS created_at, {iso.format(updated)} AS updated_at,
  {chosen(fixed.CHANNELS, channel)} AS channel, 'template' AS model, 'Egyptian' AS dialect,
  titles[{n2} % len(titles) + 1] AS title_ar, descs[{n3} % len(descs) + 1] AS description_ar,
  l1 AS category_level_1, l2 AS category_level_2, l3 AS category_level_3, path AS category_path,
  list_transform(list_sort(list_transform(pool, lambda t: md5(h || t) || t))[1:least(len(pool), {n_tags} + 2)],
    lambda t: substr(t, 33)) AS tags,
  {{'l1': l1, 'l2': l2, 'l3': l3, 'tags': tags}} AS labels_json,
  CAST({impact} + 1 AS INT) AS impact, CAST({urgency} + 1 AS INT) AS urgency,
  CAST(least(5, floor(({impact} + {urgency} + 3) / 2)) AS INT) AS priority,
  {chosen(fixed.SENTIMENTS, sentiment)} AS sentiment FROM s2)"""


ORACLE["synthesize_rows"] = f"WITH {taxonomy_cte()},\n{synth_cte()}\nSELECT {flat_columns()} FROM synth"
ORACLE["synthesize_checked"] = (
    "SELECT count(*) AS n_rows, count(*) AS n_clean, CAST(0 AS BIGINT) AS n_rejected,"
    " CAST(0 AS BIGINT) AS n_autofixed FROM documents"
)

# --- profile -----------------------------------------------------------------

ORACLE["overview"] = on_tickets(
    """SELECT metric, value FROM (SELECT count(*) AS total_rows, CAST(19 AS BIGINT) AS total_columns,
  count(DISTINCT ticket_id) AS unique_ids, count(*) - count(DISTINCT ticket_id) AS duplicate_ids,
  count(DISTINCT category_level_1) AS classes_category_level_1,
  count(DISTINCT category_level_2) AS classes_category_level_2,
  count(DISTINCT category_level_3) AS classes_category_level_3 FROM tickets)
UNPIVOT (value FOR metric IN (total_rows, total_columns, unique_ids, duplicate_ids,
  classes_category_level_1, classes_category_level_2, classes_category_level_3))"""
)
GAP_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
ORACLE["missing_by_column"] = "WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_missing,"
    f" round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2) AS pct_missing FROM j"
    for c in GAP_COLUMNS
)


def counts_sql(col: str, view: str) -> str:
    return f"SELECT {col} AS value, count(*) AS n FROM {view} WHERE {col} IS NOT NULL GROUP BY 1"


for level in (1, 2, 3):
    ORACLE[f"value_counts_l{level}"] = on_tickets(counts_sql(f"category_level_{level}", "tickets"))
for column in ("sentiment", "channel", "dialect", "priority", "urgency", "impact"):
    ORACLE[f"value_counts_{column}"] = on_tickets(counts_sql(column, "tickets"))
ORACLE["value_counts_order_status"] = counts_sql("o_orderstatus", "orders")
ORACLE["value_counts_role"] = counts_sql("role", "conversations")
for name, column in (("l1", "category_level_1"), ("sentiment", "sentiment")):
    ORACLE[f"class_shares_{name}"] = on_tickets(
        f"SELECT value, n, round(100.0 * n / sum(n) OVER (), 1) AS pct FROM ({counts_sql(column, 'tickets')})"
    )
ORACLE["class_balance"] = on_tickets(
    " UNION ALL ".join(
        f"""SELECT 'category_level_{n}' AS level, count(*) AS classes, min(n) AS min_size, max(n) AS max_size,
  round(avg(n), 4) AS mean_size, round(stddev_samp(n), 4) AS std_size, round(max(n) / min(n), 4) AS imbalance_ratio
  FROM ({counts_sql(f'category_level_{n}', 'tickets')})"""
        for n in (1, 2, 3)
    )
)


def crosstab_sql(col: str, values: list[str]) -> str:
    cells = ", ".join(f"count(*) FILTER ({col} = '{v}') AS {v}" for v in values)
    return on_tickets(f"SELECT category_level_1, {cells} FROM tickets GROUP BY 1")


ORACLE["crosstab_sentiment"] = crosstab_sql("sentiment", ["angry", "mixed", "negative", "neutral", "positive"])
ORACLE["crosstab_dialect"] = crosstab_sql("dialect", ["de", "en", "es", "fr"])
ORACLE["length_columns"] = on_tickets(
    f"SELECT pos, CAST(length(title_ar) AS INT) AS title_len, CAST(length(description_ar) AS INT) AS desc_len,"
    f" {strip('description_ar')} = '' AS desc_blank FROM tickets"
)
LENGTH_ROWS = """len AS (SELECT 'title_ar' AS field, length(title_ar) AS x FROM tickets
  UNION ALL SELECT 'description_ar', length(description_ar) FROM tickets),
rng AS (SELECT field, CAST(min(x) AS DOUBLE) AS low, CAST(max(x) AS DOUBLE) AS high, count(*) AS total,
  stddev_samp(x) * pow(count(*), -0.2) AS bw FROM len GROUP BY 1)"""
ORACLE["length_hist"] = on_tickets("SELECT 1").replace(
    "\nSELECT 1",
    f""",\n{LENGTH_ROWS},
binned AS (SELECT field, least(40, CAST(floor((x - low) * 40 / (high - low)) AS BIGINT) + 1) AS bin, count(*) AS n
  FROM len JOIN rng USING (field) GROUP BY ALL)
SELECT field, b.bin, round(low + (b.bin - 1) * (high - low) / 40, 4) AS bin_low,
  round(low + b.bin * (high - low) / 40, 4) AS bin_high, coalesce(n, 0) AS n
FROM (SELECT * FROM rng CROSS JOIN (SELECT unnest(range(1, 41)) AS bin)) b LEFT JOIN binned USING (field, bin)""",
)
ORACLE["length_kde"] = on_tickets("SELECT 1").replace(
    "\nSELECT 1",
    f""",\n{LENGTH_ROWS},
freq AS (SELECT field, x, count(*) AS n FROM len GROUP BY ALL),
grid AS (SELECT field, j, low + j * (high - low) / 199 AS point, bw, (high - low) / 40 AS width
  FROM rng, (SELECT unnest(range(0, 200)) AS j))
SELECT field, CAST(j AS INT) AS j, round(point, 4) AS point,
  round(sum(n * exp(-0.5 * pow((point - x) / bw, 2)) * width / (bw * sqrt(2 * pi()))), 4) AS height
FROM grid JOIN freq USING (field) GROUP BY field, j, point""",
)
ORACLE["length_stats"] = on_everything(
    " UNION ALL ".join(
        f"SELECT '{f}' AS field, count(*) FILTER ({f} IS NULL OR {strip(f)} = '') AS n_blank,"
        f" CAST(min(length({f})) AS INT) AS min, CAST(max(length({f})) AS INT) AS max, round(avg(length({f})), 4) AS mean,"
        f" round(median(length({f})), 4) AS median FROM everything"
        for f in ("title_ar", "description_ar")
    )
)
ORACLE["median_by_class"] = on_tickets(
    "SELECT category_level_1, round(median(length(description_ar)), 4) AS median FROM tickets GROUP BY 1"
)


def box_sql(by: str, value: str, view: str) -> str:
    return f"""SELECT {by}, round(min(x) FILTER (x BETWEEN lo AND hi), 4) AS whisker_low, round(any_value(q1), 4) AS q1,
  round(any_value(q2), 4) AS median, round(any_value(q3), 4) AS q3,
  round(max(x) FILTER (x BETWEEN lo AND hi), 4) AS whisker_high,
  count(*) FILTER (x NOT BETWEEN lo AND hi) AS n_outliers
FROM (SELECT {by}, CAST({value} AS DOUBLE) AS x FROM {view}) v JOIN (
  SELECT {by}, q1, q2, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT {by}, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS q2,
      quantile_cont({value}, 0.75) AS q3 FROM {view} GROUP BY 1)) q USING ({by}) GROUP BY 1"""


ORACLE["box_by_class"] = on_tickets(box_sql("category_level_1", "length(description_ar)", "tickets"))
ORACLE["box_quantity"] = box_sql("l_returnflag", "l_quantity", "lineitem")
ORACLE["box_price"] = box_sql("l_returnflag", "l_extendedprice", "lineitem")


def shared_sql(col: str, count: str) -> str:
    return (
        f"SELECT '{col}' AS \"check\", CAST({count} AS BIGINT) AS n, round(100.0 * {count} / sum(n), 2) AS pct"
        f" FROM (SELECT count(*) AS n FROM tickets GROUP BY {col})"
    )


ORACLE["duplicate_membership"] = on_tickets(
    " UNION ALL ".join(
        [
            shared_sql("description_ar", "coalesce(sum(n) FILTER (n > 1), 0)"),
            shared_sql("title_ar", "coalesce(sum(n) FILTER (n > 1), 0)"),
            shared_sql("ticket_id", "sum(n - 1)"),
        ]
    )
)


def top_tags_sql(tags: str, view: str) -> str:
    return (
        f"SELECT tag, count(*) AS n FROM (SELECT unnest({tags}) AS tag FROM {view})"
        " GROUP BY 1 ORDER BY n DESC, tag LIMIT 20"
    )


ORACLE["tag_top20"] = on_everything(top_tags_sql("tags", "everything"))
ORACLE["type_word_top20"] = top_tags_sql("string_split(p_type, ' ')", "part")
ORACLE["tag_parse"] = """SELECT doc_id,
  CASE doc_id % 3 WHEN 0 THEN lang || '|' || source WHEN 1 THEN lang ELSE '' END AS tags,
  CAST(CASE doc_id % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS INT) AS n_tags FROM documents"""
ORACLE["sample8"] = on_tickets(
    "SELECT ticket_id, title_ar, category_level_1, category_level_2, category_level_3, sentiment"
    " FROM tickets ORDER BY md5('42:' || pos), pos LIMIT 8"
)

ALL_TICKETS_COLUMNS = ["pos", *COLUMNS]


def profile_all_sql() -> str:
    tables = {f"counts_{n}": ("value", "n", ORACLE[f"value_counts_{n}"])
              for n in ("l1", "l2", "l3", "sentiment", "channel", "dialect", "priority", "urgency", "impact")}
    tables |= {f"shares_{n}": ("value", "n", ORACLE[f"class_shares_{n}"]) for n in ("l1", "sentiment")}
    missing = " UNION ALL ".join(f"SELECT '{c}' AS c, count(*) FILTER ({c} IS NULL) AS n FROM tickets" for c in ALL_TICKETS_COLUMNS)
    tables |= {
        "overview": ("metric", "value", ORACLE["overview"]), "missing": ("c", "n", on_tickets(missing)),
        "balance": ("level", "classes", ORACLE["class_balance"]), "length_boxes": ("category_level_1", "n_outliers", ORACLE["box_by_class"]),
        "duplicates": ('"check"', "n", ORACLE["duplicate_membership"]), "tags": ("tag", "n", on_tickets(top_tags_sql("tags", "tickets"))),
        "length_stats": ("field", '"max"', ORACLE["length_stats"].replace("FROM everything", "FROM tickets")),
        "length_histogram": ("bin", "n", ORACLE["length_hist"]), "preview": ("ticket_id", "pos", ORACLE["preview_head"]),
        "sample": ("ticket_id", "length(title_ar)", ORACLE["sample8"]),
    }
    for name in ("sentiment", "dialect"):
        tables[f"crosstab_{name}"] = (
            "category_level_1 || '/' || other", "n",
            f"SELECT * FROM ({ORACLE[f'crosstab_{name}']}) UNPIVOT (n FOR other IN (* EXCLUDE (category_level_1)))",
        )
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", CAST({key} AS VARCHAR) AS key, CAST({n} AS BIGINT) AS n FROM ({sql})"
        for name, (key, n, sql) in tables.items()
    )


ORACLE["profile_all"] = profile_all_sql()

# --- file plans --------------------------------------------------------------

NTH = "row_number() OVER (ORDER BY {}) AS nth, "
ORACLE["build_clean_lines"] = on_json(
    f"SELECT {NTH.format('pos')}"
    + flat_columns(pos=False, priority=CLEAN_PRIORITY, tags=f"array_to_string({CLEAN_TAGS}, '|')")
    + " FROM val WHERE reason = ''"
)
ORACLE["build_clean_csv"] = on_json(
    "SELECT "
    + ", ".join(
        {"tags": f"CAST(to_json({CLEAN_TAGS}) AS VARCHAR) AS tags", "priority": f"{CLEAN_PRIORITY} AS priority",
         "labels_json": "CAST(to_json(labels_json) AS VARCHAR) AS labels_json"}.get(c, c)
        for c in COLUMNS
    )
    + " FROM val WHERE reason = ''"
)
ORACLE["build_reject_lines"] = on_json(
    f"SELECT {NTH.format('pos')} reason, CASE WHEN is_record THEN ticket_id END AS ticket_id,"
    " CASE WHEN is_record THEN description_ar END AS description_ar FROM val WHERE reason <> ''"
)
ORACLE["pass_postprocess_lines"] = on_mapped(
    enriched_sql().replace("SELECT pos, ", "SELECT " + NTH.format("(dialect = 'chat'), pos"), 1)
)
ORACLE["pass_vary_lines"] = on_varied("spread", f"SELECT {NTH.format('pos')} ticket_id, description_ar FROM varied")

LOOPED = """rejected AS (SELECT * FROM val WHERE reason <> ''),
fixes AS (SELECT pos // 200 AS part, pos % 200 + 1 AS line, g.ticket_id, r.channel, r.priority, r.description_ar
  FROM given g JOIN rep r ON r.line = g.pos),
latest AS (SELECT part, ticket_id, min(line) AS first_line, arg_max(channel, line) AS channel,
  arg_max(priority, line) AS priority, arg_max(description_ar, line) AS description_ar FROM fixes GROUP BY ALL),
part_lines AS (SELECT pos // 200 AS part, pos % 200 + 1 AS line, CASE WHEN is_record THEN ticket_id END AS ticket_id,
  is_record, pos, codes, channel, priority, impact, description_ar FROM val),
targets AS (SELECT part, ticket_id, min(line) AS line FROM part_lines JOIN latest USING (part, ticket_id) GROUP BY ALL),
merged AS (
  SELECT p.part, p.line AS place, p.ticket_id, CASE WHEN l.part IS NULL THEN p.is_record ELSE true END AS is_record,
    p.pos % 71 <> 0 AS parse_ok, CASE WHEN l.part IS NULL THEN p.codes ELSE '' END AS codes,
    CASE WHEN l.part IS NULL THEN p.channel ELSE l.channel END AS channel,
    CASE WHEN l.part IS NULL THEN p.priority ELSE l.priority END AS priority,
    CASE WHEN l.part IS NULL THEN p.description_ar ELSE l.description_ar END AS description_ar
  FROM part_lines p LEFT JOIN targets t ON t.part = p.part AND t.line = p.line
  LEFT JOIN latest l ON l.part = t.part AND l.ticket_id = t.ticket_id
  UNION ALL
  SELECT part, 1000000 + first_line, ticket_id, true, true, '', channel, priority, description_ar FROM latest l
  WHERE NOT EXISTS (SELECT 1 FROM targets t WHERE t.part = l.part AND t.ticket_id = l.ticket_id)),
first_ok AS (SELECT ticket_id, min({'part': part, 'place': place}) AS fp FROM merged
  WHERE is_record AND codes IN ('', 'bad:priority_rule') GROUP BY 1),
after AS (SELECT m.*, concat_ws(',', nullif(codes, ''),
    CASE WHEN is_record AND {'part': part, 'place': place} > fp THEN 'bad:duplicate_ticket_id' END) AS all_codes
  FROM merged m LEFT JOIN first_ok f ON f.ticket_id = m.ticket_id)"""
LOOP_ROWS = """SELECT part, row_number() OVER (PARTITION BY part ORDER BY place) AS line,
  CASE WHEN length(ticket_id) > 12 THEN 'made' ELSE ticket_id END AS ticket_id,
  CASE WHEN all_codes = 'bad:priority_rule' THEN '' ELSE all_codes END AS reason, parse_ok,
  CASE WHEN is_record THEN description_ar END AS description_ar, CASE WHEN is_record THEN channel END AS channel,
  CASE WHEN is_record THEN priority END AS priority FROM after"""


def on_loop(select: str) -> str:
    return on_json("SELECT 1").replace(
        "\nSELECT 1", ",\n" + READ_JSON + ",\n" + repair_cte("given") + ",\n" + LOOPED + "\n" + select
    )


ORACLE["fix_loop"] = on_loop(LOOP_ROWS)
ORACLE["fix_loop_versions"] = on_loop(
    "SELECT part, count(*) AS n_lines, CAST(2 AS INT) AS version FROM merged GROUP BY 1"
)
ORACLE["synthesize_file"] = f"WITH {taxonomy_cte()},\n{synth_cte()}\nSELECT {flat_columns(pos=False)} FROM synth"
