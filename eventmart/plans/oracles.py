"""The same results as `queries`, in DuckDB SQL over the driver's tables."""

from __future__ import annotations

# -- inputs


def _event_json(actor: str, id_: str, created_at: str = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')") -> str:
    return f"""json_object(
        'actor', {actor},
        'created_at', {created_at},
        'id', {id_},
        'payload', json_object(
            'action', event_type, 'ref', NULL,
            'repository', json_object(
                'description', 'd' || (k % 2),
                'language', CASE WHEN event_type <> 'error' THEN event_type END,
                'stargazers_count', CAST(k % 2 AS VARCHAR))),
        'public', true,
        'repo', json_object('id', CAST(user_id AS VARCHAR), 'name', 'repo/' || user_id),
        'type', event_type)"""


_LOGIN = "json_object('login', 'actor/' || (event_id % 211))"
_ID = "CAST(event_id AS VARCHAR)"


def _raw(user_id: str = "user_id") -> str:
    """CTE raw_events: every tenth event is there twice."""
    return f"""
source AS (
    SELECT event_id, ts, {user_id} AS user_id, event_type,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events),
deliveries AS (
    SELECT *, 5 AS delay FROM source
    UNION ALL
    SELECT *, 65 FROM source WHERE event_id % 10 = 0),
raw_events AS (
    SELECT {_ID} AS event_id, event_type,
        'actor/' || (event_id % 211) AS actor_login,
        'repo/' || user_id AS repo_name,
        ts AS event_created_at,
        ts + to_seconds(delay) AS ingested_at,
        CAST({_event_json(_LOGIN, _ID)} AS VARCHAR) AS payload
    FROM deliveries)"""


_SKEWED = _raw("CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END")

_MESSAGES = f"""
source AS (
    SELECT event_id, ts, user_id, event_type,
        CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events),
originals AS (
    SELECT event_id, ts,
        CASE event_id % 50
            WHEN 0 THEN '{{not-json'
            WHEN 1 THEN CAST({_event_json(_LOGIN, "event_id")} AS VARCHAR)
            WHEN 2 THEN CAST({_event_json("NULL", _ID)} AS VARCHAR)
            WHEN 3 THEN CAST({_event_json("'someone'", _ID)} AS VARCHAR)
            WHEN 4 THEN '[1]'
            WHEN 5 THEN CAST({_event_json(_LOGIN, _ID)} AS VARCHAR) || ',{{"end-of-text":true}}]garbage'
            WHEN 6 THEN CAST({_event_json(_LOGIN, _ID, "'12:30'")} AS VARCHAR)
            ELSE CAST({_event_json(_LOGIN, _ID)} AS VARCHAR)
        END AS value
    FROM source),
messages AS MATERIALIZED (
    SELECT event_id * 2 AS msg_offset, ts AS sent_at, value FROM originals
    UNION ALL
    SELECT event_id * 2 + 1, ts + INTERVAL 60 SECOND, value FROM originals WHERE event_id % 10 = 0),
parsed AS MATERIALIZED (
    SELECT * FROM messages WHERE json_valid(value)),
objects AS MATERIALIZED (
    SELECT * FROM parsed WHERE json_type(value) = 'OBJECT')"""


def _string_at(path: str) -> str:
    return f"CASE WHEN json_type(value, '{path}') = 'VARCHAR' THEN json_extract_string(value, '{path}') END"


_NO_DATE = f"coalesce(NOT regexp_matches({_string_at('$.created_at')}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'), false)"

_DECODED = f"""{_MESSAGES},
raw_events AS (
    SELECT * FROM (
        SELECT {_string_at("$.id")} AS event_id,
            {_string_at("$.type")} AS event_type,
            {_string_at("$.actor.login")} AS actor_login,
            {_string_at("$.repo.name")} AS repo_name,
            TRY_CAST(replace({_string_at("$.created_at")}, 'Z', '') AS TIMESTAMP) AS event_created_at,
            sent_at + INTERVAL 5 SECOND AS ingested_at,
            value AS payload
        FROM objects WHERE NOT {_NO_DATE}) decoded
    WHERE event_id IS NOT NULL)"""

# -- models, over CTE raw_events

_TYPED = """
typed AS (
    SELECT event_id, event_type, actor_login, repo_name, event_created_at, ingested_at,
        json_extract_string(payload, '$.payload.action') AS action,
        json_extract_string(payload, '$.payload.ref') AS ref,
        json_extract_string(payload, '$.payload.ref_type') AS ref_type,
        json_extract_string(payload, '$.public') AS is_public,
        payload
    FROM raw_events)"""

_SILVER = f"""{_TYPED},
silver AS (
    SELECT * EXCLUDE (rank) FROM (
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ingested_at DESC) AS rank
        FROM typed) ranked
    WHERE rank = 1)"""

_SNAPSHOTS = f"""{_SILVER},
snapshots AS (
    SELECT event_id, repo_name, event_created_at,
        json_extract_string(payload, '$.repo.id') AS repo_id,
        json_extract_string(payload, '$.payload.repository.language') AS repo_language,
        json_extract_string(payload, '$.payload.repository.description') AS repo_description,
        CAST(json_extract_string(payload, '$.payload.repository.stargazers_count') AS BIGINT) AS stargazers_count
    FROM silver WHERE repo_name IS NOT NULL)"""


def _dimension(first_arm: str) -> str:
    return f"""{_SNAPSHOTS},
compared AS (
    SELECT *, event_created_at AS valid_from,
        row_number() OVER w AS position,
        lag(repo_language) OVER w AS prev_language,
        lag(repo_description) OVER w AS prev_description,
        lag(stargazers_count) OVER w AS prev_stars
    FROM snapshots
    WINDOW w AS (PARTITION BY repo_name ORDER BY event_created_at, event_id)),
opened AS (
    SELECT repo_name, repo_id, repo_language, repo_description, stargazers_count, valid_from FROM compared
    WHERE {first_arm}
        OR repo_language IS DISTINCT FROM prev_language
        OR repo_description IS DISTINCT FROM prev_description
        OR stargazers_count IS DISTINCT FROM prev_stars),
closed AS (
    SELECT *, lead(valid_from) OVER (PARTITION BY repo_name ORDER BY valid_from) AS valid_to FROM opened),
dim AS (
    SELECT md5(repo_name || CAST(valid_from AS VARCHAR)) AS repo_version_key,
        repo_name, repo_id, repo_language, repo_description, stargazers_count,
        valid_from, valid_to, valid_to IS NULL AS is_current
    FROM closed)"""


_STRICT = _dimension("position = 1")
_COMPAT = _dimension("prev_language IS NULL")


def _fact(where: str = "true") -> str:
    return f"""{_SILVER},
fact AS (
    SELECT date_trunc('hour', event_created_at) AS event_hour, event_type,
        count(*) AS event_count,
        count(DISTINCT actor_login) AS unique_actors,
        count(DISTINCT repo_name) AS unique_repos
    FROM silver WHERE {where} GROUP BY 1, 2)"""


def _check(model: str, column: str, check: str, severity: str, failures: str) -> str:
    return f"""
SELECT '{model}' AS model, '{column}' AS "column", '{check}' AS "check", '{severity}' AS severity,
    failures, CASE WHEN failures = 0 THEN 'pass' ELSE '{severity}' END AS status
FROM ({failures}) counted"""


def _nulls(model: str, table: str, columns: list[str]) -> list[str]:
    return [
        _check(model, c, "not_null", "error", f"SELECT count(*) AS failures FROM {table} WHERE {c} IS NULL")
        for c in columns
    ]


def _repeats(model: str, table: str, column: str, severity: str) -> str:
    repeated = f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    return _check(model, column, "unique", severity, f"SELECT count(*) AS failures FROM ({repeated}) repeated")


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


_RAW = _raw()
_RAW_COLUMNS = "event_id, event_type, actor_login, repo_name, event_created_at, ingested_at, payload"
_FACT_COLUMNS = "event_id, ingested_at, event_created_at, repo_name, event_type, actor_login"
_DIM_AND_FACT = f"{_RAW},{_STRICT}," + _fact()[len(_SILVER) + 1 :]


def oracle_sql() -> dict[str, str]:
    sql = {
        "bronze_decode": _with(_DECODED, f"SELECT {_RAW_COLUMNS} FROM raw_events"),
        "bronze_malformed": _with(
            _MESSAGES,
            f"""
SELECT msg_offset, value, 'malformed' AS reason FROM messages WHERE NOT json_valid(value)
UNION ALL
SELECT msg_offset, value, 'not an object' FROM parsed WHERE json_type(value) <> 'OBJECT'
UNION ALL
SELECT msg_offset, value, 'id' FROM objects WHERE json_type(value, '$.id') IS DISTINCT FROM 'VARCHAR'
UNION ALL
SELECT msg_offset, value, 'timestamp' FROM objects WHERE json_type(value, '$.id') = 'VARCHAR' AND {_NO_DATE}""",
        ),
        "bronze_partition_scan": _with(
            _RAW,
            f"""
SELECT {_RAW_COLUMNS} FROM raw_events
WHERE CAST(ingested_at AS DATE) = DATE '2024-01-10' AND event_type = 'click'""",
        ),
        "publish_key_value": _with(
            _MESSAGES,
            """
SELECT json_extract_string(value, '$.id') AS key, value FROM objects
WHERE json_type(value, '$.id') = 'VARCHAR'""",
        ),
        "publish_dedup": _with(
            _MESSAGES,
            """
SELECT event_id, msg_offset, event_json FROM (
    SELECT json_extract_string(value, '$.id') AS event_id, msg_offset, value AS event_json,
        row_number() OVER (PARTITION BY json_extract_string(value, '$.id') ORDER BY msg_offset) AS rank
    FROM objects WHERE json_type(value, '$.id') = 'VARCHAR') ranked
WHERE rank = 1
    AND event_id NOT IN (SELECT CAST(event_id AS VARCHAR) FROM events WHERE event_id % 7 = 0)""",
        ),
        "stream_publish": _with(
            _MESSAGES,
            """
SELECT DISTINCT json_extract_string(value, '$.id') AS key, value FROM objects
WHERE json_type(value, '$.id') = 'VARCHAR'""",
        ),
        "silver_typed": _with(f"{_RAW},{_TYPED}", "SELECT * FROM typed"),
        "silver_dedup": _with(f"{_RAW},{_SILVER}", "SELECT * FROM silver"),
        "lookback_filter": _with(
            f"{_RAW},{_SILVER}",
            f"""
SELECT {_FACT_COLUMNS} FROM silver
WHERE event_created_at >= TIMESTAMP '2024-01-30 23:30:00' - INTERVAL 3 HOUR""",
        ),
        "scd2_full": _with(f"{_RAW},{_STRICT}", "SELECT * FROM dim"),
        "scd2_full_compat": _with(f"{_RAW},{_COMPAT}", "SELECT * FROM dim"),
        "scd2_changes": _with(f"{_RAW},{_STRICT}", "SELECT * FROM opened"),
        "scd2_skewed": _with(f"{_SKEWED},{_STRICT}", "SELECT * FROM dim"),
        "scd2_skewed_compat": _with(f"{_SKEWED},{_COMPAT}", "SELECT * FROM dim"),
        "highwater_filter": _with(
            f"{_RAW},{_SILVER},"
            + _STRICT[len(_SILVER) + 1 :].replace("FROM silver WHERE", "FROM silver_before WHERE").replace(
                "snapshots AS (",
                "silver_before AS (SELECT * FROM silver WHERE event_created_at < TIMESTAMP '2024-01-16'),\nsnapshots AS (",
                1,
            ),
            """
SELECT event_id, repo_name, event_created_at FROM silver
WHERE repo_name IS NOT NULL
    AND event_created_at > (SELECT coalesce(max(valid_from), TIMESTAMP '1970-01-01') FROM dim)""",
        ),
        "events_hourly": _with(f"{_RAW},{_fact()}", "SELECT * FROM fact"),
        "hourly_lookback": _with(
            f"{_RAW},{_fact()}", "SELECT * FROM fact WHERE event_hour >= TIMESTAMP '2024-01-30 00:00:00'"
        ),
        "scd2_incremental": _with(f"{_RAW},{_STRICT}", "SELECT * FROM dim"),
        "hourly_incremental": _with(f"{_RAW},{_fact()}", "SELECT * FROM fact"),
        "stream_scd2": _with(f"{_DECODED},{_STRICT}", "SELECT * FROM dim"),
        "stream_hourly": _with(f"{_DECODED},{_fact()}", "SELECT * FROM fact"),
        "overall": _with(
            f"{_RAW},{_SILVER}",
            """
SELECT count(*) AS total_events, count(DISTINCT actor_login) AS unique_actors,
    count(DISTINCT repo_name) AS unique_repos, count(DISTINCT event_type) AS event_types
FROM silver""",
        ),
        "event_types": _with(
            f"{_RAW},{_SILVER}",
            "SELECT event_type, count(*) AS events FROM silver GROUP BY 1 ORDER BY 2 DESC, 1",
        ),
        "top_repos": _with(
            f"{_RAW},{_SILVER}",
            """
SELECT repo_name, count(*) AS events, count(DISTINCT actor_login) AS unique_actors,
    count(DISTINCT event_type) AS event_types
FROM silver GROUP BY 1 ORDER BY 2 DESC, 1""",
        ),
        "hourly_series": _with(
            f"{_RAW},{_fact()}", "SELECT event_hour, event_type, event_count FROM fact ORDER BY 1, 2"
        ),
        "entities_current": _with(
            f"{_RAW},{_STRICT}",
            """
SELECT repo_name, repo_language, repo_description, stargazers_count, valid_from AS first_seen
FROM dim WHERE is_current ORDER BY stargazers_count DESC, repo_name""",
        ),
        "entity_history": _with(
            f"{_RAW},{_STRICT}",
            """
SELECT valid_from, repo_language AS language, repo_description AS description, stargazers_count AS stars,
    CASE WHEN is_current THEN 'current' ELSE '' END AS flag
FROM dim WHERE repo_name = 'repo/3' ORDER BY valid_from""",
        ),
        "versions_per_repo": _with(
            f"{_RAW},{_STRICT}",
            "SELECT repo_name, count(*) AS version_count FROM dim GROUP BY 1 ORDER BY 2 DESC, 1",
        ),
        "dq_not_null": _with(
            _DIM_AND_FACT,
            " UNION ALL ".join(
                _nulls("raw_events", "raw_events", ["event_id", "event_type", "ingested_at"])
                + _nulls("silver_events", "silver", ["event_id", "event_type", "repo_name", "event_created_at"])
                + _nulls("dim_repo_scd2", "dim", ["repo_version_key", "repo_name", "valid_from", "is_current"])
                + _nulls("fct_events_hourly", "fact", ["event_hour", "event_type", "event_count"])
            ),
        ),
        "dq_unique": _with(
            f"{_RAW},{_STRICT}",
            " UNION ALL ".join(
                [
                    _repeats("raw_events", "raw_events", "event_id", "warn"),
                    _repeats("silver_events", "silver", "event_id", "error"),
                    _repeats("dim_repo_scd2", "dim", "repo_version_key", "error"),
                ]
            ),
        ),
        "dq_accepted_values": _with(
            f"{_RAW},{_SILVER}",
            _check(
                "silver_events",
                "event_type",
                "accepted_values",
                "warn",
                "SELECT count(DISTINCT event_type) AS failures FROM silver "
                "WHERE event_type NOT IN ('click', 'view', 'purchase', 'signup')",
            ),
        ),
        "dq_expression": _with(
            f"{_RAW},{_fact()}",
            _check(
                "fct_events_hourly",
                "event_count",
                "expression_is_true",
                "error",
                "SELECT count(*) AS failures FROM fact WHERE NOT (event_count >= 0)",
            ),
        ),
        "dq_freshness": _with(
            _RAW,
            """
SELECT 'raw_events' AS model, 'ingested_at' AS "column", 'freshness' AS "check",
    CASE status WHEN 'pass' THEN 'error' ELSE status END AS severity,
    CAST(status <> 'pass' AS BIGINT) AS failures, status
FROM (
    SELECT CASE WHEN age <= 15 THEN 'pass' WHEN age <= 60 THEN 'warn' ELSE 'error' END AS status
    FROM (
        SELECT date_diff('microsecond', max(ingested_at), TIMESTAMP '2024-01-31 00:20:00') / 60000000.0 AS age
        FROM raw_events) aged) judged""",
        ),
    }
    return sql
