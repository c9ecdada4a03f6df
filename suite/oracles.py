"""The same results in plain SQL over the driver tables."""

from __future__ import annotations

from ferry.fixed_values import (
    FIRST_NAMES,
    INVALID_EMAIL_DOMAINS,
    LAST_NAMES,
    LITERAL_LEDGER_DOCUMENTS,
)

EMAIL = r"^[a-zA-Z0-9._%+-]+@ais\.com$"
PHONE = r"^(06|08|09)[0-9]{8}$"
AS_OF = "TIMESTAMP '2025-01-01 00:00:00'"
USERS = "first_name, last_name, email, phone, gender"

RAW = """raw AS (
  SELECT n AS rid,
    CASE WHEN n % 40 = 7 THEN NULL WHEN n % 40 = 9 THEN '   '
         ELSE 'First' || (n % 97) END AS first_name,
    CASE WHEN n % 40 = 17 THEN '' WHEN n % 40 = 27 THEN NULL
         ELSE 'Last' || (n % 89) END AS last_name,
    CASE WHEN n % 10 = 1 THEN 'user' || n || '@example.com'
         WHEN n % 40 = 15 THEN 'user' || (n - 8) || '@ais.com'
         WHEN n % 40 = 35 THEN 'user' || (n - 5) || '@ais.com'
         WHEN n % 100 = 33 THEN NULL
         ELSE 'user' || n || '@ais.com' END AS email,
    CASE WHEN n % 60 = 2 THEN '07' || d8 WHEN n % 60 = 12 THEN '12345678'
         WHEN n % 60 = 22 THEN '06123456789' WHEN n % 60 = 32 THEN 'abc1234567'
         WHEN n % 60 = 42 THEN NULL
         ELSE CASE n % 3 WHEN 0 THEN '06' WHEN 1 THEN '08' ELSE '09' END || d8 END AS phone,
    CASE WHEN n % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM (SELECT o_orderkey AS n,
               lpad(CAST((o_orderkey * 7919) % 100000000 AS VARCHAR), 8, '0') AS d8
        FROM orders))"""

IS_VALID = f"""regexp_matches(email, '{EMAIL}')
  AND first_name IS NOT NULL AND trim(first_name, ' ') <> ''
  AND last_name IS NOT NULL AND trim(last_name, ' ') <> ''
  AND regexp_matches(phone, '{PHONE}')"""

DEDUP = """firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY email ORDER BY rid) AS rn FROM raw)
  WHERE rn = 1)"""

VALID = f"{RAW}, {DEDUP}, valid AS (SELECT {USERS} FROM firsts WHERE {IS_VALID})"

LEDGER = """ledger AS (
  SELECT event_type || '_' || user_id AS db, floor(value) / 10 AS test_version,
         ts AS created_at, ts AS updated_at, event_id AS rid
  FROM events)"""

ORDER_LEDGER = """order_ledger AS (
  SELECT 'purchase_' || o_custkey AS db, floor(o_totalprice / 1000) / 10 AS test_version,
         o_orderdate AS created_at, o_orderdate AS updated_at, o_orderkey AS rid
  FROM orders)"""

ORDER_KEYS = "order_keys AS (SELECT DISTINCT db FROM order_ledger)"

LEDGER_COLUMNS = "db, test_version, created_at, updated_at"


def best(name: str, source: str, order: str = "test_version DESC, updated_at DESC, rid DESC") -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY db ORDER BY {order}) AS rn FROM {source})
  WHERE rn = 1)"""


DOCUMENTS = """documents_of_ledger AS (
  SELECT lpad(upper(to_hex(event_id)), 24, '0') AS _id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at,
         event_type || '_' || user_id AS db, floor(value) / 10 AS test_version,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS updated_at
  FROM events)"""

LITERALS = "literals AS (SELECT * FROM (VALUES {}) AS t(_id, created_at, db, test_version, updated_at))".format(
    ", ".join(
        "('{_id}', '{created_at}', '{db}', CAST({test_version} AS DOUBLE), '{updated_at}')".format(**d)
        for d in LITERAL_LEDGER_DOCUMENTS
    )
)

VERSIONED = f"""{DOCUMENTS}, {LITERALS}, versioned AS (
  SELECT * FROM documents_of_ledger WHERE _id NOT IN (SELECT _id FROM literals)
  UNION ALL SELECT * FROM literals)"""


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


def moved(version: str) -> str:
    """The event ledger after moving the order keys on to ``version``."""
    return with_(LEDGER, ORDER_LEDGER, ORDER_KEYS, best("best", "ledger")) + f"""
SELECT {LEDGER_COLUMNS}, rid FROM ledger WHERE db NOT IN (SELECT db FROM order_keys)
UNION ALL
SELECT k.db, {version}, coalesce(b.created_at, {AS_OF}), {AS_OF}, b.rid
FROM order_keys k LEFT JOIN best b ON b.db = k.db"""


def in_store(version: str) -> str:
    """The event ledger after moving some of its keys, and one for each region."""
    return with_(
        LEDGER,
        ORDER_LEDGER,
        best("best", "ledger"),
        "c(n, v) AS (SELECT i, list_reduce(list_prepend(i, range(8)::BIGINT[]), "
        "lambda a, x: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)) FROM range(256) r(i))",
        "t AS (SELECT list(v ORDER BY n) AS t FROM c)",
        "keys AS (SELECT db FROM (SELECT DISTINCT db FROM ledger WHERE db LIKE '%0'), t "
        "WHERE xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || h)::BIGINT FOR h IN "
        "regexp_extract_all(hex(encode(db)), '..')]), lambda a, x: xor(a >> 8, t[xor(a, x) % 256 + 1])), 4294967295::BIGINT) % 16 = 0 "
        "UNION ALL SELECT 'missing_' || r_regionkey FROM region)",
    ) + f"""
SELECT {LEDGER_COLUMNS}, rid, 0::BIGINT AS changed_elsewhere, true AS some_elsewhere
FROM ledger WHERE db NOT IN (SELECT db FROM keys)
UNION ALL
SELECT k.db, {version}, coalesce(b.created_at, {AS_OF}), {AS_OF}, b.rid, 0, true
FROM keys k LEFT JOIN best b ON b.db = k.db"""


# -- synthetic users ---------------------------------------------------------


def draw(key: str, slot: int, n: str) -> str:
    block, part = divmod(slot, 4)
    digest = f"md5('0:{block}:' || ({key}))"
    return f"(CAST(('0x' || substr({digest}, {8 * part + 1}, 8)) AS BIGINT) % ({n}))"


def pick(key: str, slot: int, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{listed}], {draw(key, slot, str(len(values)))} + 1)"


def kind(key: str) -> str:
    roll = draw(key, 0, "100")
    return (
        f"CASE WHEN {roll} < 70 THEN 'valid' WHEN {roll} < 80 THEN 'invalid_email' "
        f"WHEN {roll} < 90 THEN 'invalid_phone' WHEN {roll} < 95 THEN 'missing_name' "
        "ELSE 'duplicate_email' END"
    )


def address(key: str, kind_column: str, domain: str) -> str:
    side = draw(key, 3, "2")
    return (
        f"(CASE WHEN {kind_column} = 'missing_name' AND {side} = 0 THEN 'user' "
        f"ELSE lower({pick(key, 1, FIRST_NAMES)}) END || '.' || "
        f"CASE WHEN {kind_column} = 'missing_name' AND {side} = 1 THEN 'test' "
        f"ELSE lower({pick(key, 2, LAST_NAMES)}) END || ({key}) || '@' || {domain})"
    )


def synthetic_users() -> str:
    eight = f"CAST({draw('id', 8, '90000000')} + 10000000 AS VARCHAR)"
    tenth = draw("id", 10, "10")
    side = draw("id", 3, "2")
    return f"""keyed AS (
  SELECT o_orderkey AS id, {kind('o_orderkey')} AS kind,
         CASE WHEN o_orderkey > 0
              THEN {draw('o_orderkey', 6, 'greatest(o_orderkey, 1)')} END AS earlier
  FROM orders),
linked AS (
  SELECT *, CASE WHEN kind = 'duplicate_email' THEN {kind('earlier')} END AS earlier_kind
  FROM keyed),
synthetic AS (
  SELECT
    CASE WHEN kind = 'missing_name' AND {side} = 0 THEN NULL
         ELSE {pick('id', 1, FIRST_NAMES)} END AS first_name,
    CASE WHEN kind = 'missing_name' AND {side} = 1 THEN ''
         ELSE {pick('id', 2, LAST_NAMES)} END AS last_name,
    CASE WHEN kind = 'invalid_email' THEN {address('id', 'kind', pick('id', 5, INVALID_EMAIL_DOMAINS))}
         WHEN earlier IS NOT NULL AND earlier_kind IN ('valid', 'invalid_phone', 'missing_name')
           THEN {address('earlier', 'earlier_kind', "'ais.com'")}
         ELSE {address('id', 'kind', "'ais.com'")} END AS email,
    CASE WHEN kind = 'invalid_phone' THEN
           CASE {draw('id', 9, '6')} WHEN 0 THEN '01' || {eight} WHEN 1 THEN {eight}
             WHEN 2 THEN {eight} || {tenth} WHEN 3 THEN '06' || {eight} || {tenth}
             WHEN 4 THEN 'abc' || substr({eight}, 1, 7) ELSE '07' || {eight} END
         ELSE {pick('id', 7, ['06', '08', '09'])} || {eight} END AS phone,
    {pick('id', 4, ['M', 'F'])} AS gender
  FROM linked)"""


# -- all of them -------------------------------------------------------------


def all_oracles() -> dict[str, str]:
    raw_all = with_(RAW) + f"SELECT rid, {USERS} FROM raw"
    raw_users = with_(RAW) + f"SELECT {USERS} FROM raw"
    valid_users = with_(VALID) + "SELECT * FROM valid"
    ledger_all = with_(LEDGER) + f"SELECT {LEDGER_COLUMNS}, rid FROM ledger"
    documents = with_(DOCUMENTS) + "SELECT * FROM documents_of_ledger"
    awkward = (
        "SELECT doc_id, text, lpad((doc_id % 500)::VARCHAR, 4, '0') AS code, "
        "CASE WHEN doc_id % 5 > 0 THEN (doc_id % 7) || '.50' END AS price, doc_id / 4 AS quarter, "
        "'int,string,string,decimal(3,2),double' AS kinds FROM documents"
    )
    return {
        "header_check": "SELECT v AS variant, v = 'exact' AS header_ok, c AS row_count "
        "FROM (SELECT count(*) AS c FROM orders), "
        "(SELECT unnest(['exact', 'reordered', 'extra', 'missing', 'other_case']) AS v)",
        "conform_headers": with_(RAW)
        + "SELECT first_name, last_name, email, phone, CAST(NULL AS VARCHAR) AS gender, rid FROM raw",
        "valid_email": with_(RAW)
        + f"SELECT rid, email, coalesce(regexp_matches(email, '{EMAIL}'), false) AS is_valid FROM raw",
        "valid_phone": with_(RAW)
        + f"SELECT rid, phone, coalesce(regexp_matches(phone, '{PHONE}'), false) AS is_valid FROM raw",
        "nonblank_names": with_(RAW)
        + "SELECT rid, first_name, last_name, coalesce(trim(first_name, ' ') <> '', false) AS first_ok, "
        "coalesce(trim(last_name, ' ') <> '', false) AS last_ok FROM raw",
        "validate_rows": with_(RAW) + f"SELECT * FROM raw WHERE {IS_VALID}",
        "dedup_email": with_(RAW, DEDUP) + "SELECT * FROM firsts",
        "validate_all": valid_users,
        "validation_summary": with_(VALID)
        + "SELECT t AS total, v AS valid, t - v AS invalid "
        "FROM (SELECT count(*) AS t FROM raw), (SELECT count(*) AS v FROM valid)",
        "drop_surrogate_key": raw_users,
        "target_contract": with_(
            RAW,
            """stretched AS (
  SELECT rid, repeat(first_name, rid % 60) AS first_name, last_name, email,
         repeat(phone, rid % 8) AS phone,
         CASE WHEN rid % 7 = 0 THEN 'X' WHEN rid % 11 = 0 THEN NULL ELSE gender END AS gender
  FROM raw)""",
        )
        + "SELECT * FROM stretched WHERE (gender IS NULL OR gender IN ('M', 'F')) "
        "AND (first_name IS NULL OR length(first_name) <= 255) "
        "AND (last_name IS NULL OR length(last_name) <= 255) "
        "AND (email IS NULL OR length(email) <= 255) AND (phone IS NULL OR length(phone) <= 50)",
        "ledger_key_filter": with_(LEDGER, ORDER_LEDGER, ORDER_KEYS)
        + "SELECT * FROM ledger WHERE db IN (SELECT db FROM order_keys)",
        "latest_version": with_(LEDGER, best("best", "ledger")) + "SELECT * FROM best",
        "latest_version_or_zero": with_(LEDGER, ORDER_LEDGER, ORDER_KEYS)
        + "SELECT k.db, coalesce(max(l.test_version), 0) AS test_version "
        "FROM order_keys k LEFT JOIN ledger l ON l.db = k.db GROUP BY k.db",
        "ledger_documents_bump": with_(DOCUMENTS, best("best", "documents_of_ledger", "test_version DESC, updated_at DESC, _id DESC"))
        + "SELECT _id, created_at, db, round(test_version + 0.1, 1) AS test_version, "
        "'2025-01-01T00:00:00.000Z' AS updated_at FROM best",
        "ledger_documents_compact": with_(DOCUMENTS, best("newest", "documents_of_ledger", "updated_at DESC, _id DESC"))
        + "SELECT * FROM newest",
        "csv_roundtrip_documents": "SELECT * FROM documents",
        "csv_roundtrip_conversations": "SELECT * FROM conversations",
        "csv_roundtrip_pages": "SELECT * FROM pages",
        "partitioned_text_values": "SELECT c_custkey, CASE WHEN c_nationkey % 7 <> 3 "
        "THEN lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END AS part FROM customer",
        "declared_route_table": with_(LEDGER) + f"SELECT {LEDGER_COLUMNS} FROM ledger",
        "transfer_refused_rows": with_(
            RAW.replace("raw AS (", "short AS (", 1),
            "raw AS (SELECT * REPLACE (CASE WHEN rid % 7 = 0 THEN repeat(first_name, 60) ELSE first_name END "
            "AS first_name) FROM short)",
            DEDUP,
            f"valid AS (SELECT {USERS} FROM firsts WHERE {IS_VALID})",
        )
        + f"SELECT {USERS}, CASE WHEN length(first_name) > 255 OR length(last_name) > 255 OR length(email) > 255 "
        "OR length(phone) > 50 THEN 'refused' ELSE 'table' END AS place FROM valid",
        "ledger_compact": with_(LEDGER, best("newest", "ledger", "updated_at DESC, rid DESC"))
        + "SELECT * FROM newest",
        "ledger_create": with_(LEDGER, ORDER_LEDGER, ORDER_KEYS)
        + f"SELECT {LEDGER_COLUMNS} FROM ledger UNION ALL "
        f"SELECT db, CAST(1 AS DOUBLE), {AS_OF}, {AS_OF} FROM order_keys",
        "ledger_bump": with_(LEDGER, best("best", "ledger"))
        + f"SELECT db, round(test_version + 0.1, 1) AS test_version, created_at, {AS_OF} AS updated_at, rid FROM best",
        "ledger_bump_keys": moved("coalesce(round(b.test_version + 0.1, 1), 1.0)"),
        "ledger_set": moved("CAST(2.5 AS DOUBLE)"),
        "ledger_bump_store": in_store("coalesce(round(b.test_version + 0.1, 1), 1.0)"),
        "ledger_transfer_store": in_store(
            "coalesce(nullif((SELECT max(test_version) FROM order_ledger o WHERE o.db = k.db), 0), 1.0)"
        ),
        "ledger_transfer": with_(
            LEDGER,
            ORDER_LEDGER,
            "keys AS (SELECT DISTINCT db FROM ledger UNION SELECT 'missing_' || n_nationkey FROM nation)",
            "given AS (SELECT db, max(test_version) AS v FROM ledger GROUP BY db)",
            best("best", "order_ledger"),
        )
        + f"""SELECT {LEDGER_COLUMNS}, rid FROM order_ledger WHERE db NOT IN (SELECT db FROM keys)
UNION ALL
SELECT k.db, CASE WHEN g.v IS NULL OR g.v = 0 THEN 1.0 ELSE g.v END,
       coalesce(b.created_at, {AS_OF}), {AS_OF}, b.rid
FROM keys k LEFT JOIN given g ON g.db = k.db LEFT JOIN best b ON b.db = k.db""",
        "versions_to_relational": with_(
            LEDGER,
            ORDER_LEDGER,
            "keys AS (SELECT DISTINCT db FROM ledger UNION SELECT 'missing_' || n_nationkey FROM nation)",
            "given AS (SELECT db, max(test_version) AS v FROM ledger GROUP BY db)",
            best("best", "order_ledger"),
        )
        + f"""SELECT {LEDGER_COLUMNS} FROM order_ledger WHERE db NOT IN (SELECT db FROM keys)
UNION ALL
SELECT k.db, CASE WHEN g.v IS NULL OR g.v = 0 THEN 1.0 ELSE g.v END,
       coalesce(b.created_at, {AS_OF}), {AS_OF}
FROM keys k LEFT JOIN given g ON g.db = k.db LEFT JOIN best b ON b.db = k.db""",
        "ledger_transfer_reverse": with_(
            LEDGER,
            ORDER_LEDGER,
            "given AS (SELECT db, max(test_version) AS v FROM order_ledger GROUP BY db)",
            best("best", "ledger", "test_version DESC, updated_at DESC, created_at DESC"),
        )
        + f"""SELECT {LEDGER_COLUMNS} FROM ledger WHERE db NOT IN (SELECT db FROM given)
UNION ALL
SELECT g.db, CASE WHEN g.v = 0 THEN 1.0 ELSE g.v END, coalesce(b.created_at, {AS_OF}), {AS_OF}
FROM given g LEFT JOIN best b ON b.db = g.db""",
        "upsert_by_id": with_(LEDGER, best("best", "ledger"))
        + f"""SELECT {LEDGER_COLUMNS}, rid FROM ledger WHERE rid NOT IN (SELECT rid FROM best)
UNION ALL SELECT db, round(test_version + 0.1, 1), created_at, updated_at, rid FROM best""",
        "ledger_job": with_(LEDGER, ORDER_LEDGER, ORDER_KEYS)
        + "SELECT k.db, coalesce(round(max(l.test_version) + 0.1, 1), 1.0) AS test_version "
        "FROM order_keys k LEFT JOIN ledger l ON l.db = k.db GROUP BY k.db",
        "ledger_job_relational": with_(LEDGER, ORDER_LEDGER, ORDER_KEYS)
        + "SELECT k.db, coalesce(round(max(l.test_version) + 0.1, 1), 1.0) AS test_version "
        "FROM order_keys k LEFT JOIN ledger l ON l.db = k.db GROUP BY k.db",
        "object_roundtrip_parquet": raw_all,
        "object_roundtrip_json": raw_all,
        "object_roundtrip_csv": raw_all,
        "schema_applied_scan": raw_users,
        "file_scan_sniffed": with_(LEDGER)
        + "SELECT f AS file, rid, db, test_version FROM ledger, "
        "(SELECT unnest(['rows.parquet', 'rows.json', 'rows.csv']) AS f)",
        "file_scan_text": awkward,
        "store_file_text": awkward.replace("AS kinds", "AS kinds, count(*) OVER () AS stored"),
        "transfer_partitioned": "SELECT CASE c_nationkey WHEN 1 THEN '' WHEN 2 THEN '1e3' WHEN 3 THEN NULL WHEN 4 THEN '\\' "
        "ELSE lpad(c_nationkey::VARCHAR, 3, '0') END AS part, c_custkey, "
        "(DATE '2024-02-28' + (c_custkey % 3)::INT)::DATE AS day, c_name FROM customer",
        "glob_scan": raw_all,
        "pipe_dat_scan": with_(LEDGER)
        + "SELECT '\"' || db || '\"' AS _c0, test_version AS _c1, rid AS _c2 FROM ledger",
        "object_inventory": "SELECT DISTINCT 'events/event_type=' || event_type AS folder, "
        "true AS has_bytes, true AS has_time FROM events UNION ALL SELECT 'users', true, true",
        "object_inventory_full": "SELECT 'texts' AS folder, '' AS marker, "
        "sum(strlen(coalesce(text, '')) + 1)::BIGINT AS bytes, NULL::BIGINT AS markers, true AS has_time FROM documents "
        "UNION ALL SELECT * FROM (VALUES ('texts', '_SUCCESS', 0, 1, true), ('nations', '', NULL, NULL, true), "
        "('nations', '_SUCCESS', NULL, 1, true), ('nations', '_layout.json', NULL, 1, true))",
        "schema_merge_scan": with_(RAW)
        + f"SELECT 1 AS batch, rid, first_name, last_name, email, phone, NULL AS gender FROM raw "
        f"UNION ALL SELECT 2, rid, {USERS} FROM raw",
        "schema_widen_scan": "SELECT format, c_custkey AS id, batch, "
        "CASE batch WHEN 0 THEN c_custkey::VARCHAR WHEN 1 THEN (c_custkey * 3000000000)::VARCHAR "
        "WHEN 2 THEN c_acctbal::DOUBLE::VARCHAR WHEN 3 THEN 'n' || c_custkey ELSE c_custkey::VARCHAR END AS v, "
        "CASE batch WHEN 1 THEN c_acctbal ELSE c_custkey END::DOUBLE AS w, CASE batch WHEN 2 THEN 'new' END AS x, "
        "'v:string,w:double,x:string' AS kinds "
        "FROM customer, (SELECT unnest(['parquet', 'json']) AS format), (SELECT unnest(range(5)) AS batch)",
        "partitioned_write": "SELECT event_id, user_id, ts, value, event_type FROM events",
        "write_verification": "SELECT count(*) AS expected, count(*) AS found, true AS verified FROM orders",
        "content_verification": "SELECT c_custkey, c_name, c_acctbal + n AS c_acctbal, m AS missing, 'faulty' AS copy "
        "FROM customer, (SELECT min(c_custkey) AS a, max(c_custkey) AS z FROM customer), "
        "(VALUES (0, 0, 1), (1, 0, 1), (1, 1, -1), (2, 0, -1)) v(i, n, m) "
        "WHERE c_custkey = CASE i WHEN 0 THEN a WHEN 1 THEN a + 1 ELSE z END",
        "document_roundtrip": documents,
        "jdbc_roundtrip": valid_users,
        "jdbc_partitioned_scan": ledger_all,
        "synthetic_users": with_(synthetic_users()) + "SELECT * FROM synthetic",
        "literal_versions": with_(VERSIONED) + "SELECT * FROM versioned",
        "transfer_row_count": "SELECT true AS success, count(*) AS row_count, "
        "'mongodb' AS source, 's3' AS target FROM events",
        "transfer_document_to_object": documents,
        "transfer_jdbc_to_object": ledger_all,
        "transfer_validated_document": valid_users,
        "transfer_users_append": with_(
            RAW,
            *(
                f"{n}_firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY email ORDER BY rid) AS rn "
                f"FROM raw WHERE {where}) WHERE rn = 1), {n} AS (SELECT {USERS} FROM {n}_firsts WHERE {IS_VALID})"
                for n, where in (("a", "rid % 3 > 0"), ("b", "rid % 3 <> 1"))
            ),
            "fresh AS (SELECT * FROM b WHERE email NOT IN (SELECT email FROM a))",
            "n AS (SELECT (SELECT count(*) FROM raw WHERE rid % 3 <> 1) AS total, (SELECT count(*) FROM b) AS valid, "
            "(SELECT count(*) FROM fresh) AS written)",
        )
        + f"SELECT {USERS}, total, valid, valid - written AS known, written FROM (FROM a UNION ALL FROM fresh), n",
        "transfer_validated_jdbc": valid_users,
        "source_readiness": "SELECT 'mongodb:db_connect' AS source, true AS ok, count(*) AS row_count, "
        "false AS has_error FROM events UNION ALL "
        "SELECT 's3:silver/users', true, count(*), false FROM orders UNION ALL "
        "SELECT 'postgresql:db_connect', false, 0, true",
        "object_store_job": with_(synthetic_users(), VERSIONED)
        + "SELECT 'users' AS dataset, first_name AS a, last_name AS b, email AS c, phone AS d, gender AS e FROM synthetic "
        "UNION ALL SELECT 'versions', _id, db, CAST(test_version AS VARCHAR), created_at, updated_at FROM versioned",
        "declared_route": documents,
        "declared_route_dat": with_(LEDGER) + f"SELECT {LEDGER_COLUMNS} FROM ledger",
        "transfer_report": with_(VALID)
        + """SELECT true AS success, true AS status, 'mongodb to s3' AS message, '' AS error,
       count(*) AS row_count, 0 AS total, 0 AS valid, 0 AS invalid,
       'mongodb' AS source, 's3' AS target FROM events
UNION ALL
SELECT true, true, 's3 to mongodb', '', v, t, v, t - v, 's3', 'mongodb'
FROM (SELECT count(*) AS t FROM raw), (SELECT count(*) AS v FROM valid)
UNION ALL
SELECT false, false, 's3 to mongodb', 'silver/empty holds no rows to move', 0, 0, 0, 0, 's3', 'mongodb'""",
    }
