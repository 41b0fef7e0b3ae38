"""One statement per registered query."""

from __future__ import annotations

from lumenmart.functions import UNKNOWN_SK
from lumenmart.oracle.base import day_of, dsk, names, ratio, seconds, sk
from lumenmart.plans import metrics, quality, registry, workloads
from lumenmart.plans.marts import FEATURES
from lumenmart.plans.star import TABLES
from lumenmart.sources import catalog
from lumenmart.sources import contract as C

U = UNKNOWN_SK
WM = registry.WATERMARK[:19].replace("T", " ")
AS_OF = registry.AS_OF
LATE = registry.LATE_SECONDS
# Streams emit a window once the watermark (latest event minus 3 days) has passed its end.

ENGAGEMENT = f"""SELECT m.activity_date, dau, wau, mau, {ratio('dau', 'mau')} AS stickiness_dau_mau,
        coalesce({ratio('secs', 'n', 2)}, 0.0)::DOUBLE AS avg_session_duration_seconds,
        {ratio('n', 'dau', 2)} AS sessions_per_user, {ratio('coalesce(one, 0)', 'n')} AS bounce_rate,
        {ratio('dau', '(SELECT count(*) FROM d_users WHERE is_current)')} AS feature_adoption_rate,
        (SELECT count(*) FROM d_users WHERE is_current) - mau AS dormant_users_count,
        (SELECT count(*) FROM user_sessions WHERE decile = 1) AS power_users_count
    FROM marks m LEFT JOIN (SELECT {day_of('session_start_date_sk')} AS activity_date, count(*) AS n,
            sum(session_duration_seconds) AS secs, count(*) FILTER (screens_viewed_count <= 1) AS one
        FROM fs GROUP BY 1) s USING (activity_date)"""

ACQUISITION = f"""SELECT metric_date, new_users, returning_users, total_active_users,
        (sum(new_users) OVER (ORDER BY metric_date))::BIGINT AS total_users_cumulative,
        {ratio('new_users - prev', 'prev')} AS user_growth_rate
    FROM (SELECT *, lag(new_users) OVER (ORDER BY metric_date) AS prev FROM (
        SELECT coalesce(n.d, a.d) AS metric_date, coalesce(new_users, 0) AS new_users,
            coalesce(returning_users, 0) AS returning_users, coalesce(active, 0) AS total_active_users
        FROM (SELECT registration_date AS d, count(DISTINCT user_sk) AS new_users FROM d_users GROUP BY 1) n
        FULL JOIN (SELECT activity_date AS d, count(DISTINCT user_sk) AS active,
                count(DISTINCT user_sk) FILTER (u.registration_date < activity_date) AS returning_users
            FROM act JOIN d_users u USING (user_sk) GROUP BY 1) a ON n.d = a.d))"""

ACTIVATION = f"""SELECT registration_date, total_cohort_new_users, activated_users_7d, users_first_action_rating,
        users_first_action_upload, {ratio('activated_users_7d', 'total_cohort_new_users')} AS activation_rate_7d
    FROM (SELECT registration_date, count(DISTINCT u.user_sk) AS total_cohort_new_users,
            count(DISTINCT u.user_sk) FILTER (e.event_ts <= registration_date + INTERVAL 7 DAY) AS activated_users_7d,
            count(DISTINCT u.user_sk) FILTER (e.event_name = 'discipline_rated') AS users_first_action_rating,
            count(DISTINCT u.user_sk) FILTER (e.event_name = 'material_uploaded') AS users_first_action_upload
        FROM d_users u LEFT JOIN fe e ON e.user_sk = u.user_sk GROUP BY 1)"""


def retention(rated: tuple[int, ...]) -> str:
    counts = ", ".join(
        f"count(DISTINCT u.user_sk) FILTER (activity_date = registration_date + {n}) AS d{n}_active_users" for n in (1, 7, 14, 30)
    )
    rates = ", ".join(f"{ratio(f'd{n}_active_users', 'cohort_size')} AS d{n}_retention_rate" for n in rated)
    return f"""SELECT *, {rates} FROM (SELECT registration_date AS cohort_date, count(DISTINCT u.user_sk) AS cohort_size, {counts}
        FROM d_users u LEFT JOIN act a ON a.user_sk = u.user_sk GROUP BY 1)"""


def content(fr: str = "fr", ev: str = "ev") -> str:
    return f"""SELECT coalesce(r.d, e.d) AS metric_date, coalesce(total_ratings, 0) AS total_ratings,
        coalesce({ratio('dif', 'total_ratings', 2)}, 0.0)::DOUBLE AS avg_dificuldade,
        coalesce({ratio('esf', 'total_ratings', 2)}, 0.0)::DOUBLE AS avg_esforco,
        coalesce(professors_ranked, 0) AS professors_ranked, coalesce(courses_ranked, 0) AS courses_ranked,
        coalesce(downloads, 0) AS downloads, coalesce(uploads, 0) AS uploads, coalesce(searches, 0) AS searches,
        {ratio('opened', 'searches')} AS search_success_rate, {ratio('gone', 'searches')} AS empty_search_rate
    FROM (SELECT {day_of('date_sk')} AS d, count(*) AS total_ratings, sum(dificuldade) AS dif, sum(esforco) AS esf,
            count(DISTINCT professor_sk) AS professors_ranked, count(DISTINCT course_sk) AS courses_ranked
        FROM {fr} GROUP BY 1) r
    FULL JOIN (SELECT event_date AS d, count(*) FILTER (event_name = 'material_downloaded') AS downloads,
            count(*) FILTER (event_name = 'material_uploaded') AS uploads,
            count(*) FILTER (event_name = 'search_performed') AS searches,
            count(*) FILTER (event_name = 'search_result_opened') AS opened,
            count(*) FILTER (event_name = 'search_abandoned') AS gone
        FROM {ev} GROUP BY 1) e ON r.d = e.d"""


PRODUCT = f"""SELECT *, (dense_rank() OVER (ORDER BY total_events_count DESC))::INTEGER AS rank_most_used,
        (dense_rank() OVER (ORDER BY total_events_count))::INTEGER AS rank_least_used
    FROM (SELECT '{FEATURES[0]}' AS feature_key, count(DISTINCT user_sk) FILTER (user_sk <> {U}) AS unique_users_count,
            sum(events_count)::BIGINT AS total_events_count FROM da
        UNION ALL SELECT '{FEATURES[1]}', count(DISTINCT user_sk) FILTER (user_sk <> {U}), count(*) FROM fr
        UNION ALL SELECT '{FEATURES[2]}', count(DISTINCT user_sk) FILTER (user_sk <> {U}), count(*) FROM fs)"""


def error_days(where: str = "true") -> str:
    kinds = {
        "api_errors": "api_error_occurred",
        "frontend_errors": "frontend_error_occurred",
        "upload_failures": "upload_failed",
        "login_failures": "login_failed",
        "validation_errors": "validation_error_occurred",
    }
    counts = ", ".join(f"count(*) FILTER (event_name = '{e}') AS {c}" for c, e in kinds.items())
    return f"""SELECT *, {ratio('api_errors', 'total_events')} AS api_error_rate,
            {ratio('frontend_errors', 'total_events')} AS frontend_error_rate,
            250.0::DOUBLE AS response_time_p50_ms, 650.0::DOUBLE AS response_time_p90_ms
        FROM (SELECT event_date AS error_date, {counts}, count(*) AS total_events FROM ev WHERE {where} GROUP BY 1)"""


def run_days(where: str = "true") -> str:
    return f"""SELECT run_date, total_runs, successful_runs, {ratio('successful_runs', 'total_runs')} AS pipeline_success_rate,
            {ratio('c', 'total_runs * 100', 2)} AS avg_pipeline_runtime_seconds, total_rows_extracted, total_rows_loaded
        FROM (SELECT start_time::DATE AS run_date, count(*) AS total_runs,
                count(*) FILTER (status = 'SUCCESS') AS successful_runs, sum(centis) AS c,
                sum(rows_extracted)::BIGINT AS total_rows_extracted, sum(rows_loaded)::BIGINT AS total_rows_loaded
            FROM runs WHERE {where} GROUP BY 1)"""


def readiness(share_of: str) -> str:
    return f"""SELECT total_engaged_users, top_decile_sessions, total_sessions,
        {ratio('top_decile_sessions', 'total_sessions')} AS power_user_concentration_rate,
        (SELECT count(*) FROM fe WHERE event_name IN ({names(C.HIGH_VALUE_EVENTS)})) AS high_value_feature_usage_count,
        (SELECT {ratio(f'count(DISTINCT user_sk) FILTER (university_sk = {share_of})', 'count(DISTINCT user_sk)')} FROM act)
            AS institutional_concentration_rate,
        {ratio('total_sessions', 'secs', 6)} AS willingness_to_engage_proxy
    FROM (SELECT count(*) AS total_engaged_users, (sum(session_cnt) FILTER (decile = 1))::BIGINT AS top_decile_sessions,
            sum(session_cnt)::BIGINT AS total_sessions, sum(secs) AS secs FROM user_sessions)"""


TOP_UNIVERSITY = """(SELECT university_sk FROM act GROUP BY 1 ORDER BY count(DISTINCT user_sk) DESC, university_sk LIMIT 1)"""

MARTS = {
    "mrt_acquisition": ACQUISITION,
    "mrt_activation": ACTIVATION,
    "mrt_retention": retention((1, 7, 30)),
    "mrt_engagement": ENGAGEMENT,
    "mrt_content": content(),
    "mrt_product": PRODUCT,
    "mrt_quality": error_days(),
    "mrt_data_engineering": run_days(),
    "mrt_monetization_readiness": readiness(TOP_UNIVERSITY),
}

# The engagement mart over one version of the app and two weeks.
_PERIOD = "event_ts >= TIMESTAMP '2024-01-08' AND event_ts < TIMESTAMP '2024-01-22' AND app_version = '1.1.0'"


def first_weeks(source: str, out: str) -> str:
    """`source` yields one row per member with its first day d."""
    return f"""SELECT week_start, {out}, (sum({out}) OVER (ORDER BY week_start))::BIGINT AS total,
            {ratio(f'{out} - prev', 'prev')} AS growth_rate
        FROM (SELECT *, lag({out}) OVER (ORDER BY week_start) AS prev FROM (
            SELECT date_trunc('week', d)::DATE AS week_start, count(*) AS {out} FROM ({source}) GROUP BY 1))"""


def last_days(n: int) -> str:
    return f"user_sk <> {U} AND event_date > (SELECT max(event_date) FROM ev) - {n}"


def _funnel() -> str:
    a, b, c = metrics.FUNNEL
    return f"""SELECT step, event_name, users, {ratio('users', 'prev')} AS step_rate, {ratio('users', 'top')} AS overall_rate
        FROM (SELECT *, lag(users) OVER (ORDER BY step) AS prev, first(users) OVER (ORDER BY step) AS top FROM (
            SELECT 1::INTEGER AS step, '{a}' AS event_name, (SELECT count(*) FROM f1) AS users
            UNION ALL SELECT 2, '{b}', (SELECT count(*) FROM f2)
            UNION ALL SELECT 3, '{c}', (SELECT count(*) FROM f3)))"""


_FUNNEL_CTES = {
    "f1": f"SELECT user_sk, min((event_ts, event_id)) AS at FROM fe WHERE user_sk <> {U} AND event_name = '{metrics.FUNNEL[0]}' GROUP BY 1",
    "f2": f"SELECT user_sk, min((event_ts, event_id)) AS at FROM fe JOIN f1 USING (user_sk) "
    f"WHERE event_name = '{metrics.FUNNEL[1]}' AND (event_ts, event_id) > f1.at GROUP BY 1",
    "f3": f"SELECT user_sk, min((event_ts, event_id)) AS at FROM fe JOIN f2 USING (user_sk) "
    f"WHERE event_name = '{metrics.FUNNEL[2]}' AND (event_ts, event_id) > f2.at GROUP BY 1",
}


def _flows() -> str:
    rows = []
    for flow, (a, b) in metrics.FLOWS.items():
        rows.append(
            f"""SELECT '{flow}' AS flow, count(*) FILTER (s)::BIGINT AS started, count(*) FILTER (s AND c)::BIGINT AS completed
            FROM (SELECT bool_or(event_name = '{a}') AS s, bool_or(event_name = '{b}') AS c FROM fe GROUP BY session_id)"""
        )
    flat = " UNION ALL ".join(rows)
    return f"""SELECT *, started - completed AS abandoned, {ratio('started - completed', 'started')} AS abandonment_rate
        FROM ({flat})"""


def _contract_rules() -> dict[str, str]:
    needs = {n: catalog.required_fields(n) for n, _, p, _ in catalog.EVENTS if p in ("Critical", "High")}
    missing = " ".join(
        f"WHEN '{n}' THEN NOT ({' AND '.join(f'''list_contains(keys, '{f}')''' for f in fields)})" for n, fields in needs.items() if fields
    )
    return {
        "event_id": f"NOT regexp_full_match(id, '{C.UUID_PATTERN}')",
        "event_name": f"NOT regexp_full_match(e.event_name, '{C.EVENT_NAME_PATTERN}')",
        "schema_version": "coalesce(TRY_CAST(e.schema_version AS INTEGER), 0) < 1",
        "session_id": f"NOT regexp_full_match(session_id, '{C.UUID_PATTERN}')",
        "platform": f"platform NOT IN ({names(C.CLIENT_PLATFORMS)})",
        "app_version": f"NOT regexp_full_match(app_version, '{C.SEMVER_PATTERN}')",
        "known_event": "cat.event_name IS NULL",
        "category": "e.category IS DISTINCT FROM cat.category OR cat.category IS NULL",
        "priority": "e.priority IS DISTINCT FROM cat.priority OR cat.priority IS NULL",
        "payload": f"CASE e.event_name {missing} ELSE false END",
    }


_CHECKED = "(SELECT *, json_keys(payload) AS keys FROM ae) e LEFT JOIN cat ON cat.event_name = e.event_name"


def _contract() -> str:
    counts = ", ".join(f"count(*) FILTER ({cond}) AS bad_{rule}" for rule, cond in _contract_rules().items())
    return f"SELECT e.event_name, count(*) AS events, {counts} FROM {_CHECKED} GROUP BY 1"


def _payload_field_values(kinds: tuple[str, ...] | None = None) -> str:
    rows = []
    for name, _, _, spec in catalog.EVENTS:
        for field in spec.split():
            key, kind = field.split(":")
            kind = kind.rstrip("?")
            if kinds is None or kind in kinds:
                rows.append(f"('{name}', '{key}', '{kind}')")
    return f"(VALUES {', '.join(rows)})"


def _drift() -> str:
    return f"""SELECT 'column_missing' AS kind, 'created_at' AS name, 0::BIGINT AS events
        UNION ALL SELECT 'column_unknown', 'extra', 0
        UNION ALL SELECT 'event_unknown', event_name, count(*) FROM ae
            WHERE event_name NOT IN (SELECT event_name FROM cat) GROUP BY 2
        UNION ALL SELECT 'category_unknown', category, count(*) FROM ae
            WHERE category NOT IN (SELECT category FROM cat) GROUP BY 2
        UNION ALL SELECT 'field_unknown', event_name || '.' || field, count(*)
            FROM (SELECT event_name, unnest(json_keys(payload)) AS field FROM ae)
            WHERE (event_name, field) NOT IN (SELECT (a, b) FROM {_payload_field_values()} t(a, b, c)) GROUP BY 2"""


_DQ_TABLES = {
    "stg_events": "stg_e",
    "stg_users": "stg_u",
    "fct_events": "fe",
    "fct_daily_user_activity": "da",
    "fct_ratings": "fr",
    "fct_sessions": "fs",
    "dim_users": "d_users",
    "dim_professors": "d_prof",
    "dim_courses": "d_courses",
    "dim_universities": "d_univ",
    "dim_academic_periods": "d_period",
    "dim_date": "d_date",
    "dim_screens": "d_screens",
}


def _suite() -> str:
    rows = []

    def add(check: str, failing: str) -> None:
        rows.append(f"SELECT '{check}' AS \"check\", (SELECT count(*) FROM {failing}) AS failures")

    for table, columns in quality.NOT_NULL.items():
        for c in columns:
            add(f"not_null.{table}.{c}", f"{_DQ_TABLES[table]} WHERE {c} IS NULL")
    for (table, c), values in quality.ACCEPTED.items():
        value = "CASE WHEN platform LIKE 'mobile%' THEN 'mobile' ELSE platform END" if c == "platform_group" else c
        add(f"accepted_values.{table}.{c}", f"{_DQ_TABLES[table]} WHERE {value} NOT IN ({names(values)})")
    for table, c in quality.UNIQUE.items():
        add(f"unique.{table}.{c}", f"(SELECT {c} FROM {_DQ_TABLES[table]} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
    for table, fks in quality.FOREIGN_KEYS.items():
        for fk, target in fks.items():
            dim, key = target.split(".")
            add(
                f"relationships.{table}.{fk}",
                f"{_DQ_TABLES[table]} f WHERE f.{fk} <> {U} AND NOT EXISTS (SELECT 1 FROM {_DQ_TABLES[dim]} d WHERE d.{key} = f.{fk})",
            )
    add("event_not_in_future", f"fe WHERE event_ts > TIMESTAMP '{AS_OF}' + INTERVAL 5 MINUTE")
    add("event_id_not_repeated", "(SELECT event_id FROM fe GROUP BY 1 HAVING count(*) > 1)")
    add("rating_scores_in_range", "fr WHERE dificuldade < 1 OR dificuldade > 5 OR esforco < 1 OR esforco > 5")
    add("session_duration_not_negative", "fs WHERE session_duration_seconds < 0")
    return " UNION ALL ".join(rows)


def _breaches() -> str:
    limits = quality.Limits()
    q = error_days()
    return f"""SELECT 'SLA_BREACH' AS alert, 'api_error_rate' AS metric, error_date::VARCHAR AS subject, api_error_rate AS actual,
            {limits.error_rate}::DOUBLE AS limit_value FROM ({q}) WHERE api_error_rate > {limits.error_rate}
        UNION ALL SELECT 'SLA_BREACH', 'frontend_error_rate', error_date::VARCHAR, frontend_error_rate,
            {limits.error_rate}::DOUBLE FROM ({q}) WHERE frontend_error_rate > {limits.error_rate}
        UNION ALL SELECT 'SLA_BREACH', 'duration_seconds', run_id, centis / 100, {limits.runtime_seconds}::DOUBLE
            FROM runs WHERE centis > {int(limits.runtime_seconds * 100)}
        UNION ALL SELECT * FROM (SELECT 'SLA_BREACH', 'data_freshness_hours', 'fct_events',
            floor(epoch(TIMESTAMP '{AS_OF}' - max(event_ts)) / 3600)::DOUBLE AS h, {limits.freshness_hours}::DOUBLE FROM fe)
            WHERE h > {limits.freshness_hours}
        UNION ALL SELECT 'PIPELINE_FAILURE', 'failed_run', run_id, 1::DOUBLE, 0::DOUBLE FROM runs WHERE status <> 'SUCCESS'"""


def _card(name: str) -> str:
    mart, columns, _, _ = workloads.CARDS[name]
    return f"SELECT {', '.join(columns)} FROM ({MARTS[mart]})"


def _growth_rows() -> str:
    parts = [
        f"SELECT '{t}' AS table_name, {day_of(c)} AS d FROM {cte}"
        for t, cte, c in (
            ("fct_events", "fe", "event_date_sk"),
            ("fct_daily_user_activity", "da", "date_sk"),
            ("fct_ratings", "fr", "date_sk"),
            ("fct_sessions", "fs", "session_start_date_sk"),
        )
    ]
    return " UNION ALL ".join(parts)


_SEEN = "SELECT session_id, event_ts, event_id, screen_sk FROM fe WHERE screen_sk IS NOT NULL"
_CORRECTED = f"""SELECT raw_event_id AS event_id, created_at AS event_ts, event_name FROM stg_e
    WHERE epoch(created_at - event_ts) > {LATE}"""
_REPLACED = f"""SELECT raw_event_id AS event_id,
    CASE WHEN epoch(created_at - event_ts) > {LATE} THEN created_at ELSE event_ts END AS event_ts, event_name FROM stg_e"""
_DAILY_BY_USER_ID = f"""SELECT {dsk('"timestamp"')} AS date_sk, user_id, count(DISTINCT session_id) AS session_count,
        count(*) AS events_count, count(*) FILTER (event_name IN ({names(C.RATING_EVENTS)})) AS ratings_submitted_count,
        count(*) FILTER (event_name = 'material_downloaded') AS downloads_count,
        count(*) FILTER (event_name = 'material_uploaded') AS uploads_count,
        bool_or(event_name IN ({names(C.CORE_ACTIONS)}))::INTEGER AS has_completed_core_action
    FROM ae GROUP BY 1, 2"""


def sessionized(source: str, key: str, ts: str, gap: str, extra: str = "") -> str:
    """Classic lag form; `extra` are aggregates."""
    return f"""SELECT {key}, session_number, min({ts}) AS session_start, max({ts}) AS session_end, count(*) AS events_count{extra}
        FROM (SELECT *, (sum(opens) OVER (PARTITION BY {key} ORDER BY {ts} RANGE UNBOUNDED PRECEDING))::BIGINT AS session_number
            FROM (SELECT *, CASE WHEN {ts} - lag({ts}) OVER (PARTITION BY {key} ORDER BY {ts}) <= {gap} THEN 0 ELSE 1 END AS opens
                FROM {source}))
        GROUP BY 1, 2"""


QUERIES: dict[str, str] = {
    "stg_events": "SELECT * FROM stg_e",
    "stg_users": "SELECT * FROM stg_u",
    "stg_disciplines": "SELECT * FROM stg_d",
    "incremental_read": f"SELECT id, event_name, \"timestamp\" FROM ae WHERE \"timestamp\" > TIMESTAMP '{WM}'",
    "incremental_read_limited": f"""SELECT id, "timestamp" FROM ae WHERE "timestamp" > TIMESTAMP '{WM}'
        ORDER BY "timestamp", id LIMIT 500""",
    "full_refresh_read": 'SELECT id, "timestamp" FROM ae',
    "normalised_events": f"""SELECT id, event_name, category, priority,
            CASE WHEN k % 4 <> 3 THEN schema_version ELSE '1' END AS schema_version, session_id,
            CASE WHEN k % 9 <> 8 THEN user_id ELSE 0 END AS user_id,
            CASE WHEN k % 5 <> 4 THEN platform ELSE 'web' END AS platform,
            CASE WHEN k % 6 <> 5 THEN app_version ELSE '1.0.0' END AS app_version, screen_name,
            CASE WHEN k % 2 = 0 THEN "timestamp" ELSE "timestamp" - INTERVAL 2 HOUR END AS "timestamp",
            CASE WHEN k % 10 = 9 THEN '{{}}' ELSE payload END AS payload, TIMESTAMP '{AS_OF}' AS created_at
        FROM (SELECT *, (payload->>'$.k')::INTEGER AS k FROM ae)""",
    "extracted_users": """SELECT c_custkey AS id_usuario,
            CASE WHEN c_custkey % 5 <> 4 THEN c_nationkey ELSE 1 END::BIGINT AS id_universidade,
            CASE WHEN c_custkey % 5 <> 4 THEN c_custkey % 100 END AS id_curso, 'Aluno' AS perfil,
            CASE WHEN c_custkey % 30 <> 29 THEN DATE '2023-12-25' + (c_custkey % 20)::INTEGER ELSE DATE '2026-01-01' END AS data_cadastro,
            CASE WHEN c_custkey % 10 <> 0 THEN 'inativo' ELSE 'ativo' END AS status FROM customer""",
    "extracted_disciplines": """SELECT p_partkey AS id_disciplina,
            CASE WHEN p_partkey % 3 = 0 THEN 'DISC' || p_partkey ELSE p_brand END AS codigo_disciplina,
            CASE WHEN p_partkey % 4 = 0 THEN 'Disciplina ' || p_partkey ELSE p_name END AS nome_disciplina,
            4::INTEGER AS creditos, CASE WHEN p_partkey % 5 = 0 THEN 60 ELSE p_size * 10 END::INTEGER AS ch_total FROM part""",
    "pseudonymised_events": f"SELECT raw_event_id, sha256('{registry.SALT}' || user_id) AS user_key FROM stg_e",
    "month_routing": """SELECT strftime("timestamp", '%Y-%m') AS event_month, count(*) AS events, min("timestamp") AS first_ts,
            max("timestamp") AS last_ts FROM ae GROUP BY 1""",
    "dim_date": "SELECT * FROM d_date",
    "dim_academic_periods": "SELECT * FROM d_period",
    "dim_users": "SELECT * FROM d_users",
    "dim_universities": "SELECT * FROM d_univ",
    "dim_courses": "SELECT * FROM d_courses",
    "dim_screens": "SELECT * FROM d_screens",
    "dim_professors": "SELECT * FROM d_prof",
    "professor_aliases": f"""SELECT {sk('clean')} AS professor_sk, clean AS docente_name_clean, raw AS original_docente_string,
            '["' || raw || '"]' AS raw_name_variations_json FROM spellings""",
    "dim_professors_fuzzy": f"""SELECT professor_sk, docente_name_clean, resolved_name, {sk('resolved_name')} AS resolved_sk
        FROM (SELECT a.professor_sk, a.docente_name_clean, min(b.docente_name_clean) AS resolved_name
            FROM d_prof a JOIN d_prof b ON levenshtein(lower(a.docente_name_clean), lower(b.docente_name_clean)) <= 1
            GROUP BY 1, 2)""",
    "fct_events": "SELECT * FROM fe",
    "fct_daily_user_activity": "SELECT * FROM da",
    "fct_ratings": "SELECT * FROM fr",
    "fct_sessions": "SELECT * FROM fs",
    "sessionize_30min": sessionized(
        "stg_e", "user_id", "event_ts", "INTERVAL 30 MINUTE", ", count(*) FILTER (category = 'Errors') AS errors_count"
    ),
    "scd2_history": """SELECT md5(user_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id, *,
            valid_to IS NULL AS is_current FROM versions""",
    "scd2_current": "SELECT user_id, role, status, valid_from FROM versions WHERE valid_to IS NULL",
    "scd2_asof": """SELECT e.raw_event_id, e.user_id, e.event_ts,
            CASE WHEN v.user_id IS NOT NULL
                THEN md5(v.user_id || '|' || strftime(v.valid_from, '%Y-%m-%d %H:%M:%S.%f')) END AS scd_id, v.role, v.status
        FROM stg_e e LEFT JOIN versions v ON v.user_id = e.user_id AND v.valid_from <= e.event_ts
            AND e.event_ts < coalesce(v.valid_to, TIMESTAMP '9999-12-31')""",
    "scd2_merge": f"""SELECT {sk("md5(user_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f'))")} AS user_sk, user_id,
            {sk('university_id')} AS university_sk, {sk('course_id')} AS course_sk, role, registration_date, status, valid_from,
            valid_to, valid_to IS NULL AS is_current
        FROM (SELECT o.* REPLACE (CASE WHEN p.id_usuario IS NOT NULL THEN TIMESTAMP '{AS_OF}' END AS valid_to)
            FROM snap0 o LEFT JOIN profiles p ON p.id_usuario = o.user_id AND (p.perfil <> o.role OR p.status <> o.status)
            UNION ALL
            SELECT o.user_id, o.university_id, o.course_id, p.perfil, o.registration_date, p.status, TIMESTAMP '{AS_OF}', NULL
            FROM snap0 o JOIN profiles p ON p.id_usuario = o.user_id AND (p.perfil <> o.role OR p.status <> o.status))""",
    **MARTS,
    "mrt_monetization_fixed_institution": readiness(sk("1")),
    **{name: _card(name) for name in workloads.CARDS},
    "mrt_quality_mobile": error_days("platform LIKE 'mobile%'"),
    "mrt_content_university": content("(SELECT * FROM fr WHERE user_sk IN (SELECT user_sk FROM one_univ))",
        "(SELECT * FROM ev WHERE user_sk IN (SELECT user_sk FROM one_univ))"),
    "mrt_content_course_term": content(
        f"(SELECT * FROM fr WHERE course_sk = {sk('7')} AND period_sk = {sk(chr(39) + '2024.1' + chr(39))})",
        f"(SELECT * FROM ev WHERE course_sk = {sk('7')} AND period_sk = {sk(chr(39) + '2024.1' + chr(39))})"),
    "mrt_data_engineering_success": run_days("status = 'SUCCESS'"),
    "north_star_weekly": f"""SELECT *, {ratio('core_action_wau * 100', 'total_wau', 2)} AS core_completion_rate_pct
        FROM (SELECT isoyear(activity_date)::INTEGER AS iso_year, weekofyear(activity_date)::INTEGER AS week,
            count(DISTINCT user_sk) AS total_wau, count(DISTINCT user_sk) FILTER (has_completed_core_action = 1) AS core_action_wau
            FROM act GROUP BY 1, 2)""",
    "retention_first_activity": f"""SELECT *, {ratio('retained_d7 * 100', 'cohort_size', 2)} AS d7_retention_pct,
            {ratio('retained_d30 * 100', 'cohort_size', 2)} AS d30_retention_pct
        FROM (SELECT cohort_date, count(DISTINCT user_sk) AS cohort_size,
                count(DISTINCT user_sk) FILTER (activity_date - cohort_date = 7) AS retained_d7,
                count(DISTINCT user_sk) FILTER (activity_date - cohort_date = 30) AS retained_d30
            FROM act JOIN (SELECT user_sk, min(activity_date) AS cohort_date FROM act GROUP BY 1) USING (user_sk) GROUP BY 1)""",
    "workload_a": f"""SELECT date_sk, user_sk, session_count, events_count FROM da
        WHERE date_sk = {registry.LOOKUP_DAY}
            AND user_sk = (SELECT user_sk FROM d_users WHERE user_id = {registry.LOOKUP_USER})""",
    **{
        name: f"""SELECT codigo_disciplina, nome_disciplina, round(avg(dificuldade), 6) AS avg_dificuldade,
            round(avg(esforco), 6) AS avg_esforco
        FROM fr JOIN d_courses USING (course_sk) WHERE {where} GROUP BY 1, 2"""
        for name, where in (("workload_b", f"date_sk = {registry.LOOKUP_DAY}"), ("workload_b_all_days", "true"))
    },
    **{
        name: f"""SELECT user_id, sum(session_duration_seconds)::BIGINT AS total_duration
        FROM fs JOIN d_users USING (user_sk) WHERE {where} GROUP BY 1"""
        for name, where in (("workload_c", f"session_start_date_sk = {registry.LOOKUP_DAY}"), ("workload_c_all_days", "true"))
    },
    "month_scan": """SELECT event_date_sk, category, count(*) AS events FROM fe
        WHERE event_ts >= TIMESTAMP '2024-01-01' AND event_ts < TIMESTAMP '2024-02-01' GROUP BY 1, 2""",
    "stickiness_scalar": f"""SELECT dau, active_users, {ratio('dau', 'active_users')} AS stickiness FROM (
        SELECT count(DISTINCT user_sk) FILTER (activity_date = (SELECT max(activity_date) FROM act)) AS dau,
            count(DISTINCT user_sk) AS active_users FROM act)""",
    "sql_over_views": f"""SELECT {day_of('date_sk')} AS full_date, isodow({day_of('date_sk')}) > 5 AS is_weekend, role,
            count(DISTINCT user_sk) AS users, sum(events_count)::BIGINT AS events
        FROM da JOIN d_users USING (user_sk) WHERE is_current GROUP BY 1, 2, 3""",
    "latest_run": """SELECT run_id, stage, status, rows_extracted, rows_loaded::BIGINT AS rows_loaded FROM runs
        ORDER BY start_time DESC LIMIT 1""",
    "user_growth": f"""SELECT metric_date, new_users, total_users, {ratio('new_users - pn', 'pn')} AS new_users_growth_rate,
            {ratio('total_users - pt', 'pt')} AS total_users_growth_rate
        FROM (SELECT *, lag(new_users) OVER w AS pn, lag(total_users) OVER w AS pt FROM (
            SELECT r AS metric_date, (SELECT count(*) FROM d_users WHERE registration_date = r) AS new_users,
                (SELECT count(*) FROM d_users WHERE registration_date <= r) AS total_users
            FROM (SELECT DISTINCT registration_date AS r FROM d_users)) WINDOW w AS (ORDER BY metric_date))""",
    "registration_rate": f"""SELECT *, {ratio('registrations', 'unauthenticated_sessions')} AS registration_rate FROM (
        SELECT {day_of('d')} AS metric_date, count(*) AS unauthenticated_sessions,
            count(*) FILTER (reg)::BIGINT AS registrations
        FROM (SELECT session_id, min(event_date_sk) AS d, arg_min(category, (event_ts, event_id)) AS c,
                bool_or(event_name = 'user_registered') AS reg FROM fe GROUP BY 1)
        WHERE c = 'Auth' GROUP BY 1)""",
    "university_growth": first_weeks(
        f"SELECT university_sk, min(activity_date) AS d FROM act WHERE university_sk <> {U} GROUP BY 1", "new_universities"
    ),
    "course_growth": first_weeks("SELECT course_sk, min(event_date) AS d FROM ev WHERE course_sk IS NOT NULL GROUP BY 1", "new_courses"),
    "activation_by_definition": f"""SELECT *, {ratio('activated_users', 'new_users')} AS activation_rate FROM (
        SELECT registration_date, count(*) AS new_users,
            count(*) FILTER (activated_at <= registration_date + INTERVAL 7 DAY) AS activated_users FROM activation GROUP BY 1)""",
    "time_to_activation": f"""SELECT count(*) AS activated_users, round(quantile_cont(s, 0.5) / 3600, 4) AS median_hours
        FROM (SELECT {seconds('registration_date::TIMESTAMP', 'activated_at')} AS s FROM activation WHERE activated_at IS NOT NULL)""",
    "first_action_share": f"""SELECT *, {ratio('first_ratings', 'activated_users')} AS first_rating_share,
            {ratio('first_uploads', 'activated_users')} AS first_upload_share
        FROM (SELECT count(activated_by) AS activated_users,
            count(*) FILTER (activated_by IN ({names(C.RATING_EVENTS)})) AS first_ratings,
            count(*) FILTER (activated_by = 'material_uploaded') AS first_uploads FROM activation)""",
    "first_session_completion": f"""SELECT *, {ratio('first_session_completed', 'new_users')} AS completion_rate FROM (
        SELECT registration_date, count(*) AS new_users, count(*) FILTER (done) AS first_session_completed
        FROM d_users LEFT JOIN (SELECT user_sk, arg_min(done, (start, session_id)) AS done
            FROM (SELECT user_sk, session_id, min(event_ts) AS start, bool_or(event_name IN ({names(C.ACTIVATION_EVENTS)})) AS done
                FROM fe GROUP BY 1, 2) GROUP BY 1) USING (user_sk) GROUP BY 1)""",
    "retention_rates": retention((1, 7, 14, 30)),
    "cohort_week_matrix": f"""SELECT m.*, {ratio('active_users', 'cohort_size')} AS retention_rate FROM ({{matrix}}) m""",
    "cohort_week_pivot": f"""SELECT cohort_week, cohort_size, {', '.join(f"coalesce(max(active_users) FILTER (week_number = {n}), 0) AS week_{n}" for n in range(6))}
        FROM ({{matrix}}) GROUP BY 1, 2""",
    "rolling_retention": f"""SELECT *, {', '.join(f"{ratio(f'd{n}_rolling_users', 'cohort_size')} AS d{n}_rolling_rate" for n in (1, 7, 14, 30))}
        FROM (SELECT registration_date AS cohort_date, count(DISTINCT u.user_sk) AS cohort_size,
            {', '.join(f"count(DISTINCT u.user_sk) FILTER (activity_date >= registration_date + {n}) AS d{n}_rolling_users" for n in (1, 7, 14, 30))}
            FROM d_users u LEFT JOIN act a ON a.user_sk = u.user_sk GROUP BY 1)""",
    "wau_mau": f"SELECT activity_date, wau, mau, {ratio('wau', 'mau')} AS wau_mau FROM marks",
    "session_percentiles": f"""SELECT {day_of('session_start_date_sk')} AS activity_date, count(*) AS sessions,
            round(quantile_cont(session_duration_seconds, 0.5), 6) AS p50_seconds,
            round(quantile_cont(session_duration_seconds, 0.9), 6) AS p90_seconds FROM fs GROUP BY 1""",
    "feature_adoption": f"""SELECT *, {ratio('feature_users', 'mau')} AS adoption_rate FROM (
        SELECT category AS feature_key, count(DISTINCT user_sk) AS feature_users,
            (SELECT count(DISTINCT user_sk) FROM ev WHERE {last_days(30)}) AS mau FROM ev WHERE {last_days(30)} GROUP BY 1)""",
    "high_value_usage": f"""SELECT *, {ratio('high_value_users', 'mau')} AS usage_rate FROM (
        SELECT count(DISTINCT user_sk) FILTER (event_name IN ({names(C.HIGH_VALUE_EVENTS)})) AS high_value_users,
            count(DISTINCT user_sk) AS mau FROM ev WHERE {last_days(30)})""",
    "bounce_by_definition": f"""SELECT *, {ratio('single_event_sessions', 'total_sessions')} AS bounce_rate FROM (
        SELECT {day_of('d')} AS activity_date, count(*) AS total_sessions, count(*) FILTER (n = 1) AS single_event_sessions
        FROM (SELECT session_id, min(event_date_sk) AS d, count(*) AS n FROM fe GROUP BY 1) GROUP BY 1)""",
    "power_users": "SELECT user_sk, session_cnt, decile::INTEGER AS decile FROM user_sessions WHERE decile = 1",
    "user_deciles": f"""SELECT *, {ratio('sessions', '(SELECT sum(session_cnt) FROM user_sessions)')} AS session_share FROM (
        SELECT decile::INTEGER AS decile, count(*) AS users, sum(session_cnt)::BIGINT AS sessions FROM user_sessions GROUP BY 1)""",
    "dormant_users": """SELECT as_of, n::INTEGER AS window_days, count(*) FILTER (last_day < as_of - (n - 1)) AS dormant_users
        FROM (SELECT user_sk, max(activity_date) AS last_day FROM act GROUP BY 1),
            (SELECT max(activity_date) AS as_of FROM act), (VALUES (7), (30)) w(n) GROUP BY 1, 2""",
    "empty_search_by_definition": f"""SELECT *, {ratio('empty_searches', 'searches')} AS empty_search_rate FROM (
        SELECT event_date AS metric_date, count(*) AS searches,
            count(*) FILTER ((payload_json->>'$.result_count')::INTEGER = 0) AS empty_searches
        FROM ev WHERE event_name = 'search_performed' GROUP BY 1)""",
    "funnel_conversion": _funnel(),
    "flow_abandonment": _flows(),
    "feature_ranking": f"""SELECT *, (dense_rank() OVER (ORDER BY unique_users DESC))::INTEGER AS rank_by_users,
            (dense_rank() OVER (ORDER BY total_events DESC))::INTEGER AS rank_by_events,
            (dense_rank() OVER (ORDER BY total_events))::INTEGER AS rank_least_used
        FROM (SELECT category AS feature_key, count(DISTINCT user_sk) FILTER (user_sk <> {U}) AS unique_users,
            count(*) AS total_events FROM fe GROUP BY 1)""",
    "navigation_flow": f"""SELECT *, (dense_rank() OVER (ORDER BY transition_count DESC))::INTEGER AS rank FROM (
        SELECT p.screen_name AS prev_screen, q.screen_name AS next_screen, count(*) AS transition_count
        FROM (SELECT screen_sk, lead(screen_sk) OVER (PARTITION BY session_id ORDER BY event_ts, event_id) AS nx FROM ({_SEEN})) t
        JOIN d_screens p ON p.screen_sk = t.screen_sk JOIN d_screens q ON q.screen_sk = t.nx GROUP BY 1, 2)""",
    "frontend_error_sessions": f"""SELECT *, {ratio('sessions_with_error', 'total_sessions')} AS frontend_error_rate FROM (
        SELECT {day_of('d')} AS error_date, count(*) AS total_sessions, count(*) FILTER (bad) AS sessions_with_error
        FROM (SELECT session_id, min(event_date_sk) AS d, bool_or(event_name = 'frontend_error_occurred') AS bad
            FROM fe GROUP BY 1) GROUP BY 1)""",
    "failure_shares": f"""SELECT *, {ratio('failed_uploads', 'total_uploads')} AS upload_failure_rate,
            {ratio('failed_logins', 'total_logins')} AS login_failure_rate
        FROM (SELECT event_date AS error_date, count(*) FILTER (event_name = 'upload_failed') AS failed_uploads,
            count(*) FILTER (event_name IN ('upload_failed', 'material_uploaded')) AS total_uploads,
            count(*) FILTER (event_name = 'login_failed') AS failed_logins,
            count(*) FILTER (event_name IN ('login_failed', 'login_succeeded')) AS total_logins FROM ev GROUP BY 1)""",
    "latency_percentiles": """SELECT event_date AS error_date, count(*) AS requests, round(quantile_cont(ms, 0.5), 6) AS p50_ms,
            round(quantile_cont(ms, 0.9), 6) AS p90_ms
        FROM (SELECT event_date, (payload_json->>'$.latency_ms')::BIGINT AS ms FROM ev) GROUP BY 1""",
    "etl_duration_by_stage": f"""SELECT stage, count(*) AS runs, {ratio('sum(centis)', 'count(*) * 100', 2)} AS avg_duration_seconds,
            (max(centis) / 100)::DOUBLE AS max_duration_seconds FROM runs GROUP BY 1""",
    "event_volume": "SELECT event_date, count(*) AS event_count FROM ev GROUP BY 1",
    "data_freshness": f"""SELECT m AS latest_event_ts, {seconds('m', f"TIMESTAMP '{AS_OF}'")} AS age_seconds,
            {seconds('m', f"TIMESTAMP '{AS_OF}'")} < 86400 AS is_fresh FROM (SELECT max(event_ts) AS m FROM fe)""",
    "duplicate_events": """SELECT count(*) AS total_events, count(DISTINCT id) AS distinct_events,
            count(*) - count(DISTINCT id) AS duplicate_events FROM deliveries""",
    "late_events": f"""SELECT *, {ratio('late_events', 'total_events')} AS late_rate FROM (
        SELECT event_ts::DATE AS event_date, count(*) AS total_events,
            count(*) FILTER (epoch(created_at - event_ts) > {LATE}) AS late_events,
            max(epoch(created_at - event_ts))::BIGINT AS max_delay_seconds FROM stg_e GROUP BY 1)""",
    "warehouse_growth": f"""SELECT table_name, week_start, row_count, {ratio('row_count - prev', 'prev')} AS growth_rate
        FROM (SELECT *, lag(row_count) OVER (PARTITION BY table_name ORDER BY week_start) AS prev FROM (
            SELECT table_name, date_trunc('week', d)::DATE AS week_start, count(*) AS row_count FROM ({_growth_rows()}) GROUP BY 1, 2))""",
    "institution_topn": f"""SELECT university_sk, users, rank::INTEGER AS rank, {ratio('users', 'total')} AS share,
            {ratio('running', 'total')} AS cumulative_share
        FROM (SELECT *, row_number() OVER w AS rank, sum(users) OVER w AS running, sum(users) OVER () AS total
            FROM (SELECT university_sk, count(DISTINCT user_sk) AS users FROM act GROUP BY 1)
            WINDOW w AS (ORDER BY users DESC, university_sk ROWS UNBOUNDED PRECEDING)) WHERE rank <= 5""",
    "engagement_corr": f"""SELECT count(*) AS users, round(corr(s, f), 6) AS sessions_features_corr FROM (
        SELECT user_sk, count(DISTINCT session_id) AS s, count(DISTINCT category) AS f FROM fe WHERE user_sk <> {U} GROUP BY 1)""",
    "admin_actions": """SELECT event_date AS action_date, coalesce(payload_json->>'$.action_type', 'unknown') AS action_type,
            count(*) AS actions FROM ev WHERE event_name = 'admin_action_performed' GROUP BY 1, 2""",
    "reengagement_rate": f"""SELECT *, {ratio('opened', 'sent')} AS reengagement_rate FROM (
        SELECT event_date AS metric_date, count(*) FILTER (event_name = 'notification_sent') AS sent,
            count(*) FILTER (event_name = 'notification_opened') AS opened FROM ev GROUP BY 1)""",
    "dq_suite": _suite(),
    "dq_future_events": "SELECT event_id, event_name, event_ts FROM fe WHERE event_ts > TIMESTAMP '2024-01-20 00:05:00'",
    "dq_repeated_ids": "SELECT id, count(*) AS occurrence_count FROM deliveries GROUP BY 1 HAVING count(*) > 1",
    "dq_orphan_customers": """SELECT o_custkey, count(*) AS rows FROM orders
        WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1""",
    "dq_metric_bounds": f"""SELECT 'stickiness' AS metric, activity_date AS metric_date, stickiness_dau_mau AS value
            FROM ({ENGAGEMENT}) WHERE stickiness_dau_mau NOT BETWEEN 0 AND 1
        UNION ALL SELECT 'avg_dificuldade', metric_date, avg_dificuldade FROM ({content()})
            WHERE total_ratings > 0 AND avg_dificuldade NOT BETWEEN 1 AND 5
        UNION ALL SELECT 'avg_esforco', metric_date, avg_esforco FROM ({content()})
            WHERE total_ratings > 0 AND avg_esforco NOT BETWEEN 1 AND 5""",
    "event_contract": _contract(),
    "quarantined_events": f"""SELECT id, e.event_name FROM {_CHECKED}
        WHERE {' OR '.join(f'coalesce({cond}, true)' for cond in _contract_rules().values())}""",
    "watermark_state": """SELECT 'events_sample' AS source, max("timestamp") AS value FROM ae
        UNION ALL SELECT 'arrivals_sample', max(created_at) FROM ae""",
    "schema_drift": _drift(),
    "payload_types": f"""SELECT event_name, field, field_type, count(*) AS events
        FROM (SELECT a.event_name, t.field, t.field_type, json_type(a.payload, '$.' || t.field) AS found
            FROM ae a JOIN {_payload_field_values()} t(event_name, field, field_type) ON t.event_name = a.event_name)
        WHERE found <> 'NULL' AND NOT CASE field_type WHEN 'integer' THEN found IN ('BIGINT', 'UBIGINT')
            WHEN 'number' THEN found IN ('BIGINT', 'UBIGINT', 'DOUBLE') WHEN 'string' THEN found = 'VARCHAR' ELSE found = upper(field_type) END
        GROUP BY 1, 2, 3""",
    "health_probe": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {_DQ_TABLES[t]}" for t in TABLES),
    "threshold_breaches": _breaches(),
    "incremental_append": 'SELECT id, event_name, user_id, "timestamp", created_at FROM ae',
    "upsert_users": """SELECT u.id_usuario, u.id_universidade, u.id_curso, p.perfil, u.data_cadastro, p.status
        FROM usuarios u JOIN profiles p USING (id_usuario)""",
    "insert_disciplines": """SELECT id_disciplina, codigo_disciplina,
            CASE WHEN creditos = 4 THEN nome_disciplina ELSE upper(nome_disciplina) END AS nome_disciplina, creditos, ch_total
        FROM disciplinas""",
    "delete_insert": _REPLACED,
    "stored_append": """SELECT strftime("timestamp", '%Y-%m') AS event_month, "timestamp"::DATE AS event_date, count(*) AS events,
            count(DISTINCT id) AS ids FROM ae GROUP BY 1, 2""",
    "stored_delete_insert": f"SELECT *, strftime(event_ts, '%Y-%m') AS event_month FROM ({_REPLACED})",
    "mart_export": f"""SELECT error_date::VARCHAR AS sort_value, '{{"error_date":"' || error_date || '","api_errors":' || api_errors
            || ',"total_events":' || total_events || '}}' AS row_json
        FROM ({error_days()}) ORDER BY error_date DESC LIMIT 10""",
    "stream_deduplicated": 'SELECT id, event_name, user_id, "timestamp" FROM ae',
    "stream_append": 'SELECT id, event_name, user_id, "timestamp" FROM ae',
    "stream_daily_activity": _DAILY_BY_USER_ID,
    "stream_session_windows": f"""SELECT user_id, events_count, session_start, session_end
        FROM ({sessionized('stg_e', 'user_id', 'event_ts', "INTERVAL 30 MINUTE")})""",
    "stream_sliding_actives": """SELECT d AS activity_date,
            (SELECT count(DISTINCT user_id) FROM ae x WHERE x."timestamp"::DATE BETWEEN d - 6 AND d) AS active_users
        FROM (SELECT DISTINCT "timestamp"::DATE AS d FROM ae)""",
    "stream_audit": """SELECT 'load_events' AS dag_id, 'stream' AS lane, 'SUCCESS' AS status,
            count(*) + count(*) FILTER (date_diff('second', "timestamp", created_at) >= 172800) AS rows_extracted, count(*) AS rows_loaded FROM ae""",
    "stream_closed_sessions": f"""SELECT user_id, events_count, session_start, session_end
        FROM ({sessionized('in_time', 'user_id', 't', "INTERVAL 30 MINUTE")})
        WHERE session_end + INTERVAL 30 MINUTE <= (SELECT max(t) FROM in_time) - INTERVAL {registry.CLOSING_DELAY} SECOND""",
    "stream_late_rows": """SELECT user_id, count(*) AS late_events, max(t) AS last_ts FROM parts WHERE t < mark GROUP BY 1""",
    "sketched_actives": f"""SELECT activity_date, 'all' AS platform, wau, mau, true AS wau_close, true AS mau_close FROM marks
        UNION ALL SELECT d, 'mobile_ios', (SELECT count(DISTINCT user_sk) FROM mobile_days x WHERE x.d BETWEEN m.d - 6 AND m.d),
            (SELECT count(DISTINCT user_sk) FROM mobile_days x WHERE x.d BETWEEN m.d - 29 AND m.d), true, true
        FROM (SELECT DISTINCT d FROM mobile_days) m""",
    "sketched_durations": f"""SELECT date_trunc('week', {day_of('session_start_date_sk')})::DATE AS week, count(*) AS sessions,
        true AS p50_close, true AS p90_close FROM fs GROUP BY 1""",
    "append_other_month": 'SELECT id, event_name, "timestamp" FROM ae',
    "limited_loads": 'SELECT id, event_name, "timestamp" FROM ae',
    "stream_trailing_actives": """SELECT d AS activity_date, count(DISTINCT user_id) AS dau,
            (SELECT count(DISTINCT user_id) FROM ae x WHERE x."timestamp"::DATE BETWEEN d - 6 AND d) AS wau,
            (SELECT count(DISTINCT user_id) FROM ae x WHERE x."timestamp"::DATE BETWEEN d - 29 AND d) AS mau
        FROM (SELECT *, "timestamp"::DATE AS d FROM ae) GROUP BY d""",
    "stream_upsert": f"SELECT *, strftime(event_ts, '%Y-%m') AS event_month FROM ({_REPLACED})",
    "orders_trailing_customers": """SELECT d AS order_day, count(DISTINCT o_custkey) AS customers_1d,
            (SELECT count(DISTINCT o_custkey) FROM orders x WHERE x.o_orderdate::DATE BETWEEN d - 6 AND d) AS customers_7d,
            (SELECT count(DISTINCT o_custkey) FROM orders x WHERE x.o_orderdate::DATE BETWEEN d - 29 AND d) AS customers_30d
        FROM (SELECT *, o_orderdate::DATE AS d FROM orders) GROUP BY d""",
    "orders_history": """SELECT o_custkey, o_orderpriority, o_orderstatus, moment AS valid_from, lead(moment) OVER w AS valid_to,
            lead(moment) OVER w IS NULL AS is_current
        FROM (SELECT *, lag(o_orderpriority) OVER w AS p0, lag(o_orderstatus) OVER w AS s0
            FROM (SELECT o_custkey, o_orderdate::TIMESTAMP AS moment, o_orderpriority, o_orderstatus FROM orders
                QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)
            WINDOW w AS (PARTITION BY o_custkey ORDER BY moment))
        WHERE p0 IS NULL OR p0 <> o_orderpriority OR s0 <> o_orderstatus WINDOW w AS (PARTITION BY o_custkey ORDER BY moment)""",
    "orders_idle_periods": sessionized(
        "(SELECT *, o_orderdate::TIMESTAMP AS moment FROM orders)",
        "o_custkey",
        "moment",
        "INTERVAL 90 DAY",
        ", sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents",
    ),
    "orders_price_percentiles": """SELECT o_orderpriority, count(*) AS n, round(quantile_cont(o_totalprice, 0.5), 6) AS p50,
            round(quantile_cont(o_totalprice, 0.9), 6) AS p90, round(quantile_cont(o_totalprice, 0.99), 6) AS p99
        FROM orders GROUP BY 1""",
    "orders_first_purchase_retention": f"""SELECT *, {ratio('returned', 'customers')} AS return_rate FROM (
        SELECT date_trunc('quarter', f)::DATE AS cohort_quarter, count(DISTINCT o_custkey) AS customers,
            count(DISTINCT o_custkey) FILTER (d > f AND d <= f + 365) AS returned
        FROM (SELECT o_custkey, o_orderdate::DATE AS d, min(o_orderdate::DATE) OVER (PARTITION BY o_custkey) AS f FROM orders) GROUP BY 1)""",
}

_MATRIX = """SELECT cohort_week, week_number, cohort_size, active_users FROM (
        SELECT date_trunc('week', registration_date)::DATE AS cohort_week,
            ((activity_date - registration_date) // 7)::INTEGER AS week_number, count(DISTINCT a.user_sk) AS active_users
        FROM act a JOIN d_users u ON u.user_sk = a.user_sk WHERE activity_date >= registration_date GROUP BY 1, 2)
    JOIN (SELECT date_trunc('week', registration_date)::DATE AS cohort_week, count(*) AS cohort_size FROM d_users GROUP BY 1)
        USING (cohort_week)"""
QUERIES["cohort_week_matrix"] = QUERIES["cohort_week_matrix"].replace("{matrix}", _MATRIX)
QUERIES["cohort_week_pivot"] = QUERIES["cohort_week_pivot"].replace("{matrix}", _MATRIX)

QUERIES["bitmap_retention_rates"] = QUERIES["retention_rates"]
for _name in ("rolling_retention", "dormant_users", "cohort_week_matrix"):
    QUERIES[f"bitmap_{_name}"] = QUERIES[_name]

# A part is what arrives between two runs; its mark is the newest time of the parts before, less the delay.
_PARTS = {
    "parts": f"""SELECT user_id, t, (SELECT max("timestamp") FROM ae x WHERE x.created_at < a.since) - INTERVAL {registry.CLOSING_DELAY} SECOND AS mark
        FROM (SELECT user_id, "timestamp" AS t, CASE {' '.join(f"WHEN created_at >= TIMESTAMP '{d}' THEN TIMESTAMP '{d}'" for d in reversed(registry.ARRIVALS))} END AS since FROM ae) a""",
    "in_time": "SELECT user_id, t FROM parts WHERE mark IS NULL OR t >= mark",
}

# Table expressions that only single queries need.
LOCAL_CTES: dict[str, dict[str, str]] = {
    "funnel_conversion": _FUNNEL_CTES,
    "stream_closed_sessions": _PARTS,
    "stream_late_rows": _PARTS,
    "sketched_actives": {"mobile_days": f"SELECT user_sk, {day_of('event_date_sk')} AS d FROM fe WHERE platform = 'mobile_ios' AND user_sk <> {U}"},
    "mrt_content_university": {"one_univ": f"SELECT user_sk FROM d_users WHERE university_sk = {sk('1')}"},
    # The period filter acts on the fact, so everything above it is rebuilt on the filtered fact.
    "mrt_engagement_period": {"fe": f"SELECT * FROM fe0 WHERE {_PERIOD}"},
}
QUERIES["mrt_engagement_period"] = ENGAGEMENT
QUERIES["json_source"] = QUERIES["normalised_events"]
