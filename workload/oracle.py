"""The same queries as plain SQL over the benchmark tables, written independently of the operators."""

from __future__ import annotations

IDF = """
idf AS (
  SELECT 'SEGMENT__' || upper(event_type) || '_APP__IDENTIFIES' AS metadata_table,
    CAST(event_id AS VARCHAR) AS id,
    'anon-' || CAST(event_id % 997 AS VARCHAR) AS anonymous_id,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN event_id % 7 = 0 OR user_id % 8 = 5 THEN NULL
         ELSE 'Customer#' || lpad(CAST(CASE WHEN user_id % 6 = 0 OR user_id % 10 = 3
                OR (user_id % 6 = 2 AND event_id % 13 = 0) THEN user_id + 1 ELSE user_id END AS VARCHAR), 9, '0')
    END AS email,
    CASE WHEN event_type = 'error' OR event_id % 5 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS rid,
    ts AS received_at, ts - INTERVAL '2' SECOND AS sent_at
  FROM events
)"""
EI = "ei AS (SELECT CAST(c_custkey AS VARCHAR) AS uuid, c_name AS username FROM customer WHERE c_custkey % 10 <> 3)"
PU = "pu AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey % 3 <> 0)"
WT = """
wt AS (
  SELECT CAST(event_id AS VARCHAR) AS rid,
    CAST(CASE WHEN user_id % 4 = 0 THEN user_id + 1 ELSE user_id END AS VARCHAR) AS user_id
  FROM events WHERE event_id % 3 <> 0
  UNION ALL
  SELECT CAST(event_id AS VARCHAR) AS rid, CAST(user_id AS VARCHAR) AS user_id FROM events WHERE event_id % 18 = 1
)"""
CAT = """
cat AS (
  SELECT CASE n_regionkey
      WHEN 0 THEN 'SEGMENT__' || upper(n_name) || '_DEV__IDENTIFIES'
      WHEN 1 THEN 'IDENTIFIES_' || upper(n_name)
      WHEN 2 THEN 'SEGMENT__' || upper(n_name) || '__TRACKS'
      ELSE 'SEGMENT__' || upper(n_name) || '_PROD__IDENTIFIES' END AS table_name,
    column_name, 'TEXT' AS data_type
  FROM nation CROSS JOIN (VALUES ('ID',0),('ANONYMOUS_ID',10),('USER_ID',20),('EMAIL',31),('RECEIVED_AT',2),
    ('SENT_AT',3),('TIMESTAMP',4),('RID',6),('CONTEXT_IP',7)) AS v(column_name, ord)
  WHERE (n_nationkey + ord) % 5 <> 0
)"""
M_USER_ID = """
m_user_id AS (
  SELECT i.metadata_table, i.user_id, min(e.uuid) AS user_id_uuid
  FROM idf i LEFT JOIN ei e ON i.user_id = e.uuid WHERE i.user_id IS NOT NULL GROUP BY ALL
)"""
M_USERNAME = """
m_username AS (
  SELECT i.metadata_table, i.user_id, min(e.uuid) AS username_uuid
  FROM idf i LEFT JOIN ei e ON i.email = e.username WHERE i.user_id IS NOT NULL GROUP BY ALL
)"""
M_PERSONA = """
m_persona AS (
  SELECT i.metadata_table, i.user_id, min(e.uuid) AS persona_uuid
  FROM idf i JOIN pu p ON i.user_id = p.id LEFT JOIN ei e ON p.id = e.uuid GROUP BY ALL
)"""
M_RID = """
m_rid AS (
  SELECT i.metadata_table, i.user_id, min(e.uuid) AS rid_uuid
  FROM idf i JOIN wt w ON i.rid = w.rid LEFT JOIN ei e ON w.user_id = e.uuid
  WHERE i.user_id IS NOT NULL GROUP BY ALL
)"""
RES = """
res AS (
  SELECT i.*, a.user_id_uuid, b.username_uuid, c.persona_uuid, d.rid_uuid
  FROM idf i
  LEFT JOIN m_user_id a ON a.metadata_table = i.metadata_table AND a.user_id = i.user_id
  LEFT JOIN m_username b ON b.metadata_table = i.metadata_table AND b.user_id = i.user_id
  LEFT JOIN m_persona c ON c.metadata_table = i.metadata_table AND c.user_id = i.user_id
  LEFT JOIN m_rid d ON d.metadata_table = i.metadata_table AND d.user_id = i.user_id
)"""
PAIR_COLUMNS = [
    ("user_id_uuid", "username_uuid"),
    ("user_id_uuid", "persona_uuid"),
    ("user_id_uuid", "rid_uuid"),
    ("username_uuid", "persona_uuid"),
    ("username_uuid", "rid_uuid"),
    ("persona_uuid", "rid_uuid"),
]
COMBO_COLUMNS = [
    *PAIR_COLUMNS,
    ("user_id_uuid", "username_uuid", "persona_uuid"),
    ("user_id_uuid", "username_uuid", "rid_uuid"),
    ("user_id_uuid", "persona_uuid", "rid_uuid"),
    ("username_uuid", "persona_uuid", "rid_uuid"),
    ("user_id_uuid", "username_uuid", "persona_uuid", "rid_uuid"),
]
UUIDS = ["user_id_uuid", "username_uuid", "persona_uuid", "rid_uuid"]


def _combo_select(columns: tuple[str, ...]) -> str:
    same = " AND ".join(f"{columns[0]} = {c}" for c in columns[1:])
    some = " AND ".join(f"count({c}) > 0" for c in columns)
    return (
        f"SELECT metadata_table, '{'-'.join(columns)}' AS combo, count(*) FILTER (WHERE {same}) AS n "
        f"FROM res GROUP BY metadata_table HAVING {some}"
    )


COMBO = "combo AS (\n" + "\nUNION ALL\n".join(_combo_select(c) for c in COMBO_COLUMNS) + "\n)"
PAIR = "pair AS (\n" + "\nUNION ALL\n".join(_combo_select(c) for c in PAIR_COLUMNS) + "\n)"
BEST = """
best AS (
  SELECT metadata_table, combo, n FROM pair WHERE n > 0
  QUALIFY row_number() OVER (PARTITION BY metadata_table ORDER BY n DESC, combo) = 1
)"""
CONS = (
    "cons AS (SELECT res.*, CASE "
    + " ".join(f"WHEN best.combo = '{a}-{b}' AND {a} = {b} THEN {a}" for a, b in PAIR_COLUMNS)
    + " END AS consensus FROM res LEFT JOIN best ON best.metadata_table = res.metadata_table)"
)
REST = (
    "rest AS ("
    + " UNION ALL ".join(
        f"SELECT metadata_table, '{c}' AS fallback, count({c}) AS n FROM cons WHERE consensus IS NULL "
        "GROUP BY metadata_table"
        for c in UUIDS
    )
    + ")"
)
FALL = """
fall AS (
  SELECT metadata_table, fallback, n FROM rest WHERE n > 0
  QUALIFY row_number() OVER (PARTITION BY metadata_table ORDER BY n DESC, fallback) = 1
)"""
VALID = (
    "valid AS (SELECT cons.*, fall.fallback, coalesce(consensus, CASE fall.fallback "
    + " ".join(f"WHEN '{c}' THEN {c}" for c in UUIDS)
    + " END) AS valid_uuid FROM cons LEFT JOIN fall ON fall.metadata_table = cons.metadata_table)"
)
TRACKED = "('ID','ANONYMOUS_ID','USER_ID','EMAIL','RECEIVED_AT','SENT_AT','TIMESTAMP','RID')"
DECODED = """
decoded AS (
  SELECT *, CASE WHEN contains(replace(table_name, '__', '.'), '.') THEN replace(table_name, '__', '.')
    ELSE 'LOOKER_SOURCE.PUBLIC.' || table_name END AS segment_table
  FROM cat
)"""
WANTED = """
wanted AS (
  SELECT * FROM decoded WHERE contains(segment_table, 'IDENTIFIES') AND NOT contains(segment_table, 'DEV')
    AND NOT contains(segment_table, 'STAGING') AND NOT contains(segment_table, 'IDENTIFIES_METADATA')
)"""
DESCRIPTOR = f"""
descriptor AS (
  SELECT segment_table, replace(replace(segment_table, 'LOOKER_SOURCE.PUBLIC.', ''), '.', '__') AS metadata_table,
    list(DISTINCT column_name ORDER BY column_name) AS columns
  FROM wanted WHERE column_name IN {TRACKED} GROUP BY segment_table
  HAVING count(DISTINCT column_name) FILTER (WHERE column_name IN ('ID','ANONYMOUS_ID','USER_ID','EMAIL')) = 4
)"""

RESOLVED = [IDF, EI, PU, WT, M_USER_ID, M_USERNAME, M_PERSONA, M_RID, RES]
CHOSEN = [*RESOLVED, PAIR, BEST, CONS, REST, FALL]
VALIDATED = [*CHOSEN, VALID]
DESCRIBED = [CAT, DECODED, WANTED, DESCRIPTOR]


def _with(views: list[str], select: str) -> str:
    return f"WITH {', '.join(view.strip() for view in views)}\n{select.strip()}"


def _one_path(view: str, column: str, needs: list[str]) -> str:
    return _with(
        [IDF, *needs, view],
        f"""SELECT i.metadata_table, i.id, i.user_id, m.{column} FROM idf i
        LEFT JOIN m_{column.removesuffix('_uuid')} m
          ON m.metadata_table = i.metadata_table AND m.user_id = i.user_id""",
    )


def _rate(column: str, view: str, other: str) -> str:
    return f"""
      SELECT '{column}' AS column_name, count({column}) AS n_values,
        count({column}) FILTER (WHERE {column} IN (SELECT {other} FROM {view} WHERE {other} IS NOT NULL)) AS n_matched
      FROM idf"""


BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TIMES = ", ".join(f"{c} + to_microseconds(CAST(id AS BIGINT) % 1000000) AS {c}" for c in ("received_at", "sent_at"))
NO_ROWS = "SEGMENT__EMPTY_APP__IDENTIFIES"

# Values that a table may carry from an earlier run: every row has some, whether or not its user has a hit.
PREVIOUS = """
prev AS (
  SELECT *, 'old-' || id AS o_user_id, 'old-' || id AS o_username, 'old-' || id AS o_persona, 'old-' || id AS o_rid
  FROM idf
)"""
USER_MAP = """SELECT metadata_table, user_id, count(*) AS n_rows, max(user_id_uuid) AS user_id_uuid,
  max(username_uuid) AS username_uuid, max(persona_uuid) AS persona_uuid, max(rid_uuid) AS rid_uuid
FROM res GROUP BY metadata_table, user_id"""
RERUN = """SELECT i.metadata_table, i.id, i.user_id,
  CASE WHEN i.user_id IS NULL THEN i.o_user_id ELSE a.user_id_uuid END AS user_id_uuid,
  CASE WHEN i.user_id IS NULL THEN i.o_username ELSE b.username_uuid END AS username_uuid,
  CASE WHEN c.user_id IS NULL THEN i.o_persona ELSE c.persona_uuid END AS persona_uuid,
  CASE WHEN d.user_id IS NULL THEN i.o_rid ELSE d.rid_uuid END AS rid_uuid
FROM prev i
LEFT JOIN m_user_id a ON a.metadata_table = i.metadata_table AND a.user_id = i.user_id
LEFT JOIN m_username b ON b.metadata_table = i.metadata_table AND b.user_id = i.user_id
LEFT JOIN m_persona c ON c.metadata_table = i.metadata_table AND c.user_id = i.user_id
LEFT JOIN m_rid d ON d.metadata_table = i.metadata_table AND d.user_id = i.user_id"""


def oracle_sql() -> dict[str, str]:
    return {
        # joins and resolution
        "resolve_user_id": _one_path(M_USER_ID, "user_id_uuid", [EI]),
        "resolve_username": _one_path(M_USERNAME, "username_uuid", [EI]),
        "resolve_persona": _one_path(M_PERSONA, "persona_uuid", [EI, PU]),
        "resolve_rid": _one_path(M_RID, "rid_uuid", [EI, WT]),
        "resolve_all": _with(
            RESOLVED,
            """SELECT metadata_table, id, anonymous_id, user_id, email, rid,
              user_id_uuid, username_uuid, persona_uuid, rid_uuid FROM res""",
        ),
        "user_map": _with(RESOLVED, USER_MAP),
        "user_map_screened": _with(RESOLVED, USER_MAP),
        "resolve_rerun_keep_clear": _with([*RESOLVED[:-1], PREVIOUS], RERUN),
        "rerun_of_store": _with([*RESOLVED[:-1], PREVIOUS], RERUN),
        "resolve_three_phase": _with(
            [IDF, EI, PU, WT],
            """SELECT i.metadata_table, i.id, i.user_id, i.rid, i.email, coalesce(p1, p2, p3) AS uuid,
              CASE WHEN p1 IS NOT NULL THEN 1 WHEN p2 IS NOT NULL THEN 2 WHEN p3 IS NOT NULL THEN 3 END AS phase
            FROM idf i
            LEFT JOIN (SELECT DISTINCT uuid AS p1 FROM ei) a ON a.p1 = i.user_id
            LEFT JOIN (SELECT wt.rid, min(ei.uuid) AS p2 FROM wt JOIN pu ON pu.id = wt.user_id
              JOIN ei ON ei.uuid = pu.id GROUP BY wt.rid) b ON b.rid = i.rid
            LEFT JOIN (SELECT username, min(uuid) AS p3 FROM ei GROUP BY username) c ON c.username = i.email""",
        ),
        "match_rates": _with(
            [IDF, EI, WT],
            "SELECT *, CASE WHEN n_values > 0 THEN CAST(n_matched AS DOUBLE) * 100 / n_values ELSE 0.0 END"
            " AS match_percent FROM ("
            + " UNION ALL ".join(
                [_rate("user_id", "ei", "uuid"), _rate("email", "ei", "username"), _rate("rid", "wt", "rid")]
            )
            + ")",
        ),
        "match_rate_of_emails": _with(
            [IDF, EI],
            f"""SELECT n_values, n_matched, CAST(n_matched AS DOUBLE) * 100 / n_values AS match_percent
            FROM ({_rate("email", "ei", "username")})""",
        ),
        # aggregations
        "row_count": _with([IDF], "SELECT metadata_table, count(*) AS total FROM idf GROUP BY metadata_table"),
        "non_null_counts": _with(
            [IDF],
            """SELECT metadata_table, count(user_id) AS user_id, count(email) AS email, count(rid) AS rid
            FROM idf GROUP BY metadata_table""",
        ),
        "uuid_counts_user_id": _with(
            [IDF, EI, M_USER_ID],
            """SELECT i.metadata_table, count(*) AS total, count(m.user_id_uuid) AS user_id_uuid FROM idf i
            LEFT JOIN m_user_id m ON m.metadata_table = i.metadata_table AND m.user_id = i.user_id
            GROUP BY i.metadata_table""",
        ),
        "uuid_counts": _with(
            RESOLVED,
            """SELECT metadata_table, count(*) AS total, count(user_id_uuid) AS user_id_uuid,
              count(username_uuid) AS username_uuid, count(persona_uuid) AS persona_uuid, count(rid_uuid) AS rid_uuid
            FROM res GROUP BY metadata_table""",
        ),
        "uuid_counts_long": _with(
            RESOLVED,
            " UNION ALL ".join(
                f"SELECT metadata_table, '{name}' AS name, count({what}) AS n FROM res GROUP BY metadata_table"
                for name, what in [("total", "*"), *[(c, c) for c in UUIDS]]
            ),
        ),
        "all_equal_summary": _with(
            RESOLVED,
            """SELECT *, CASE WHEN total_count > 0 THEN CAST(all_4_equal_count AS DOUBLE) * 100 / total_count
              ELSE 0.0 END AS all_4_equal_percent
            FROM (SELECT metadata_table, count(*) AS total_count, count(*) FILTER (WHERE user_id = user_id_uuid
              AND user_id_uuid = username_uuid AND username_uuid = persona_uuid) AS all_4_equal_count
              FROM res GROUP BY metadata_table)""",
        ),
        "combo_counts": _with([*RESOLVED, COMBO], "SELECT * FROM combo"),
        "combo_report": _with(
            [*RESOLVED, COMBO],
            "SELECT metadata_table || '@' || upper(combo) AS label, format('{:,}', n) AS n FROM combo",
        ),
        "report_labels": _with(
            [*RESOLVED, COMBO],
            """SELECT metadata_table || '@' || upper(combo) AS label, metadata_table AS table_part,
              split_part(combo, '-', 1) AS first_column, split_part(combo, '-', 2) AS second_column,
              metadata_table || ' @ ' || upper(split_part(combo, '-', 1)) AS column_label FROM combo""",
        ),
        # valid id
        "best_combo": _with([*RESOLVED, PAIR, BEST], "SELECT * FROM best"),
        "fallback_column": _with(CHOSEN, "SELECT * FROM fall"),
        "valid_uuid_consensus": _with(
            [*RESOLVED, PAIR, BEST, CONS], "SELECT metadata_table, id, user_id, consensus AS valid_uuid FROM cons"
        ),
        "fill_remainder": _with(VALIDATED, "SELECT metadata_table, id, user_id, valid_uuid FROM valid"),
        "valid_uuid": _with(
            VALIDATED,
            "SELECT metadata_table, id, user_id, user_id_uuid, username_uuid, persona_uuid, rid_uuid, valid_uuid"
            " FROM valid",
        ),
        "valid_uuid_given_choice": _with(
            RESOLVED,
            """SELECT metadata_table, id, coalesce(CASE WHEN user_id_uuid = persona_uuid THEN user_id_uuid END,
              CASE WHEN metadata_table LIKE '%CLICK%' THEN rid_uuid ELSE username_uuid END) AS valid_uuid FROM res""",
        ),
        "valid_uuid_reset": _with(
            [IDF], "SELECT metadata_table, id, CAST(NULL AS VARCHAR) AS valid_uuid FROM idf"
        ),
        "valid_uuid_counts": _with(
            VALIDATED, "SELECT metadata_table, count(valid_uuid) AS valid_uuid FROM valid GROUP BY metadata_table"
        ),
        "null_valid_uuid_counts": _with(
            VALIDATED,
            "SELECT metadata_table, count(*) - count(valid_uuid) AS unresolved FROM valid GROUP BY metadata_table",
        ),
        "fillable_counts": _with(
            [*RESOLVED, PAIR, BEST, CONS],
            "SELECT metadata_table, "
            + ", ".join(f"count({c}) FILTER (WHERE consensus IS NULL) AS {c}" for c in UUIDS)
            + " FROM cons GROUP BY metadata_table",
        ),
        # catalog and names
        "column_catalog": " UNION ALL ".join(
            f"SELECT '{name.upper()}' AS table_name, upper(column_name) AS column_name, "
            f"(SELECT count(*) FROM {name}) AS n_rows FROM (DESCRIBE {name})"
            for name in BASE_TABLES
        ),
        "encode_names": _with(
            [CAT, DECODED],
            """SELECT DISTINCT segment_table,
              replace(replace(segment_table, 'LOOKER_SOURCE.PUBLIC.', ''), '.', '__') AS metadata_table FROM decoded""",
        ),
        "decode_names": _with([CAT, DECODED], "SELECT DISTINCT table_name, segment_table FROM decoded"),
        "name_filter": _with([CAT, DECODED, WANTED], "SELECT DISTINCT segment_table FROM wanted"),
        "tracked_columns": _with(
            [CAT], f"SELECT table_name, column_name FROM cat WHERE column_name IN {TRACKED}"
        ),
        "table_columns": _with(
            [CAT], "SELECT DISTINCT column_name FROM cat WHERE table_name = 'SEGMENT__NATION_8_PROD__IDENTIFIES'"
        ),
        "identifies_tables": _with(
            [CAT], "SELECT DISTINCT table_name FROM cat WHERE table_name LIKE '%IDENTIFIES'"
        ),
        "discover_tables": _with(
            DESCRIBED,
            "SELECT segment_table, metadata_table, array_to_string(columns, '-') AS columns FROM descriptor",
        ),
        "descriptor_of": _with(
            DESCRIBED,
            """SELECT segment_table, metadata_table, array_to_string(columns, '-') AS columns FROM descriptor
            WHERE segment_table = 'SEGMENT.NATION_8_PROD.IDENTIFIES'""",
        ),
        "column_list_round_trip": _with(
            DESCRIBED,
            "SELECT metadata_table, len(columns) AS n_columns, columns[1] AS first_column, "
            "columns[len(columns)] AS last_column FROM descriptor",
        ),
        "planned_paths": _with(
            DESCRIBED,
            """SELECT metadata_table, replace(new_uuid, 'uuid', 'query') AS name, new_uuid,
              upper(new_uuid) AS uuid_column, array_to_string(columns, '-') || '-' || upper(new_uuid) AS columns
            FROM (SELECT *, unnest(['user_id_uuid', 'username_uuid', 'persona_uuid', 'rid_uuid']) AS new_uuid
              FROM descriptor)
            WHERE new_uuid <> 'rid_uuid' OR list_contains(columns, 'RID')""",
        ),
        "preview_counts": _with(
            DESCRIBED,
            "SELECT metadata_table, CAST(NULL AS BIGINT) AS total, "
            + ", ".join(f"CAST(NULL AS BIGINT) AS {c}" for c in UUIDS)
            + " FROM descriptor",
        ),
        "preview_combos": _with(
            DESCRIBED,
            " UNION ALL ".join(
                f"SELECT metadata_table, '{'-'.join(c)}' AS combo, CAST(NULL AS BIGINT) AS n FROM descriptor"
                + (" WHERE list_contains(columns, 'RID')" if "rid_uuid" in c else "")
                for c in COMBO_COLUMNS
            ),
        ),
        # projections, filters, sets
        "tracked_projection": _with([IDF], "SELECT id, anonymous_id, user_id, email, rid FROM idf"),
        "complete_rows": _with(
            [IDF],
            """SELECT metadata_table, id, anonymous_id, user_id, email, rid FROM idf WHERE id IS NOT NULL
              AND anonymous_id IS NOT NULL AND user_id IS NOT NULL AND email IS NOT NULL AND rid IS NOT NULL""",
        ),
        "null_split": _with(
            [IDF],
            """SELECT 'with' AS part, metadata_table, id FROM idf WHERE user_id IS NOT NULL
            UNION ALL SELECT 'without', metadata_table, id FROM idf WHERE user_id IS NULL""",
        ),
        "added_column": _with([IDF], "SELECT id, user_id, CAST(NULL AS VARCHAR) AS valid_uuid FROM idf"),
        "resolution_time": _with(
            [IDF, EI, M_USER_ID],
            """SELECT i.id, m.user_id_uuid, '2024-02-01 00:00:00' AS user_id_query_timestamp FROM idf i
            LEFT JOIN m_user_id m ON m.metadata_table = i.metadata_table AND m.user_id = i.user_id""",
        ),
        "records": _with([IDF], "SELECT id AS record_id, user_id AS record_user_id FROM idf"),
        "distinct_rows": _with([IDF], "SELECT DISTINCT metadata_table, user_id, email FROM idf"),
        "first_n": _with(
            [IDF], "SELECT metadata_table, id, user_id FROM idf ORDER BY metadata_table, id LIMIT 10"
        ),
        "union_tables": _with(
            [IDF],
            """SELECT split_part(metadata_table, '_', 3) AS metadata_table, id, user_id,
              CASE WHEN metadata_table NOT LIKE '%ERROR%' THEN rid END AS rid FROM idf""",
        ),
        "count_reconciliation": _with(
            [IDF],
            """SELECT metadata_table, count(*) AS source_count, count(*) AS copy_count, true AS equal
            FROM idf GROUP BY metadata_table""",
        ),
        "differing_rows": _with(
            [IDF],
            """SELECT metadata_table, user_id, count(*) FILTER (WHERE email IS NULL) AS n FROM idf
            GROUP BY metadata_table, user_id HAVING n > 0""",
        ),
        "empty_lists": _with(
            [IDF], "SELECT id, user_id IS NULL AND email IS NULL AND rid IS NULL AS no_keys FROM idf"
        ),
        # text
        "normalize_text": r"""SELECT doc_id, trim(regexp_replace(text,
              '[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+',
              ' ', 'g')) AS text FROM documents""",
        "to_bool": """SELECT doc_id, word, CASE WHEN word IS NOT NULL THEN lower(word) IN ('yes', 'true', 't', '1') END AS flag
            FROM (SELECT doc_id, CASE WHEN quality IS NULL THEN NULL WHEN doc_id % 3 = 0 THEN CAST(quality AS VARCHAR)
              WHEN doc_id % 3 = 1 THEN CASE WHEN quality = 1 THEN 'true' ELSE 'false' END
              WHEN quality = 1 THEN 'YES' ELSE 'No' END AS word FROM labels)""",
        # snapshots and tables
        "snapshot_round_trip": _with(
            [IDF], f"SELECT metadata_table, id, anonymous_id, user_id, email, rid, {TIMES} FROM idf"
        ),
        "snapshot_round_trip_csv": _with(
            [IDF], f"SELECT id, metadata_table, anonymous_id, user_id, email, rid, {TIMES} FROM idf"
        ),
        "latest_snapshot": _with([IDF], "SELECT id, user_id FROM idf WHERE user_id IS NOT NULL"),
        "load_or_compute": _with(
            DESCRIBED,
            "SELECT segment_table, metadata_table, array_to_string(columns, '-') AS columns FROM descriptor",
        ),
        "existing_tables": _with(
            [IDF],
            """SELECT metadata_table AS name, true AS found, true AS written, count(*) AS n_rows FROM idf
            GROUP BY metadata_table""",
        ),
        "table_descriptions": _with(
            [IDF],
            f"""SELECT table_name, column_name, CASE WHEN column_name LIKE '%\\_at' ESCAPE '\\' THEN 'timestamp_ntz'
                WHEN column_name = 'user_id' AND table_name LIKE '%CLICK%' THEN 'bigint' ELSE 'string' END AS type,
              true AS nullable, n_rows
            FROM (SELECT *, unnest(['id', 'anonymous_id', 'user_id', 'email', 'rid', 'received_at', 'sent_at', 'page'])
                AS column_name
              FROM (SELECT metadata_table AS table_name, count(*) AS n_rows FROM idf GROUP BY metadata_table
                UNION ALL SELECT '{NO_ROWS}', 0))
            WHERE column_name <> 'rid' OR table_name NOT LIKE '%ERROR%'""",
        ),
        "run_of_tables": _with(
            VALIDATED,
            """SELECT metadata_table, id, user_id, '/p/' || id AS page, user_id_uuid, username_uuid, persona_uuid,
              rid_uuid, valid_uuid FROM valid""",
        ),
        "latest_run_of_tables": _with(
            VALIDATED,
            """SELECT metadata_table, id, user_id, '/p/' || id AS page, user_id_uuid, username_uuid, persona_uuid,
              rid_uuid, valid_uuid FROM valid""",
        ),
        "resolution_times_of_tables": _with(
            [IDF], "SELECT metadata_table, id, '2024-02-01 00:00:00' AS resolved_at FROM idf"
        ),
        "rerun_of_tables": _with(
            [*RESOLVED[:-1], PREVIOUS],
            """SELECT i.metadata_table, i.id, i.user_id, '/p/' || i.id AS page,
              CASE WHEN i.user_id IS NULL THEN i.o_user_id ELSE a.user_id_uuid END AS user_id_uuid,
              CASE WHEN i.user_id IS NULL THEN i.o_username ELSE b.username_uuid END AS username_uuid,
              CASE WHEN c.user_id IS NULL THEN i.o_persona ELSE c.persona_uuid END AS persona_uuid,
              CASE WHEN d.user_id IS NULL THEN i.o_rid ELSE d.rid_uuid END AS rid_uuid
            FROM prev i
            LEFT JOIN m_user_id a ON a.metadata_table = i.metadata_table AND a.user_id = i.user_id
            LEFT JOIN m_username b ON b.metadata_table = i.metadata_table AND b.user_id = i.user_id
            LEFT JOIN m_persona c ON c.metadata_table = i.metadata_table AND c.user_id = i.user_id
            LEFT JOIN m_rid d ON d.metadata_table = i.metadata_table AND d.user_id = i.user_id""",
        ),
        "uuid_counts_of_tables": _with(
            RESOLVED,
            f"""SELECT metadata_table, count(*) AS total, count(user_id_uuid) AS user_id_uuid,
              count(username_uuid) AS username_uuid, count(persona_uuid) AS persona_uuid,
              CASE WHEN metadata_table NOT LIKE '%ERROR%' THEN count(rid_uuid) END AS rid_uuid
            FROM res GROUP BY metadata_table UNION ALL SELECT '{NO_ROWS}', 0, 0, 0, 0, 0""",
        ),
        "reports_of_tables": _with(
            VALIDATED,
            f"""SELECT *, CASE WHEN total > 0 THEN CAST(all_4_equal_count AS DOUBLE) * 100 / total ELSE 0.0 END
              AS all_4_equal_percent
            FROM (SELECT metadata_table, count(*) AS total, count(*) AS total_count, count(*) FILTER (WHERE
                user_id = user_id_uuid AND user_id_uuid = username_uuid AND username_uuid = persona_uuid)
                AS all_4_equal_count, count(valid_uuid) AS valid_uuid, count(*) - count(valid_uuid) AS unresolved
              FROM valid GROUP BY metadata_table UNION ALL SELECT '{NO_ROWS}', 0, 0, 0, 0, 0)""",
        ),
        "clone_tables": _with(
            [IDF],
            """SELECT metadata_table, id, anonymous_id, user_id, email, rid, '/p/' || id AS page,
              CAST(NULL AS VARCHAR) AS user_id_uuid, 'first' AS run_name FROM idf""",
        ),
    }
