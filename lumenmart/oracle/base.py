"""Common table expressions of the oracle: adapter, staging, dimensions, facts.

They follow the definitions, not the Spark plans: dimension keys come from
joins, distinct counts are DISTINCT, trailing windows are subqueries.
"""

from __future__ import annotations

from lumenmart.functions import UNKNOWN_SK
from lumenmart.sources import catalog
from lumenmart.sources import contract as C
from lumenmart.sources import sample


def names(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def pick(values: tuple[str, ...], index: str) -> str:
    return f"[{names(values)}][({index}) + 1]"


def sk(x: str) -> str:
    return f"('0x' || substr(md5(({x})::VARCHAR), 1, 15))::BIGINT"


def dsk(ts: str) -> str:
    return f"strftime({ts}, '%Y%m%d')::INTEGER"


def day_of(date_sk: str) -> str:
    return f"strptime({date_sk}::VARCHAR, '%Y%m%d')::DATE"


def ratio(num: str, den: str, scale: int = 4) -> str:
    """num/den in whole numbers, rounded half up."""
    n, d = f"({num})::HUGEINT", f"({den})::HUGEINT"
    p = 10**scale
    return (
        f"CASE WHEN ({den}) <> 0 THEN (CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * "
        f"((abs({n}) * {2 * p} + {d}) // (2 * {d})))::DOUBLE / {p} END"
    )


def seconds(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a}) + 500000) // 1000000)::BIGINT"


def _event_name() -> str:
    branches = " ".join(f"WHEN '{k}' THEN {pick(v, f'k % {len(v)}')}" for k, v in sample.EVENT_NAMES.items())
    return f"CASE event_type {branches} END"


_TEACHER = f"""CASE user_id % 3
    WHEN 0 THEN 'Prof. ' || fn || ' ' || ln
    WHEN 1 THEN '  Prof.  ' || fn || '   ' || ln || ' '
    ELSE 'Prof. ' || fn || '  ' || ln END"""

CTES: dict[str, str] = {
    "cat": f"SELECT * FROM (VALUES {catalog.values_sql()}) t(event_name, category, priority, schema_version)",
    "ek": f"""SELECT *, {_event_name()} AS event_name,
            {pick(sample.FIRST_NAMES, '(k // 10) % 10')} || CASE WHEN user_id % 5 = 4 THEN 'h' ELSE '' END AS fn,
            {pick(sample.LAST_NAMES, 'k % 10')} AS ln
        FROM (SELECT *, (props->>'$.k')::INTEGER AS k FROM events)""",
    "ae": f"""SELECT event_id::VARCHAR AS id, e.event_name, category, priority, schema_version,
            user_id || '-' || strftime(ts, '%Y%m%d') || '-' || CASE WHEN hour(ts) < 12 THEN 'a' ELSE 'p' END AS session_id,
            user_id, {pick(sample.PLATFORMS, 'k % 3')} AS platform, {pick(sample.APP_VERSIONS, 'k % 3')} AS app_version,
            CASE WHEN k % 11 <> 10 THEN lower(category) || '_' || (k % 7) END AS screen_name,
            ts AS "timestamp",
            '{{"k": ' || k || ', "course_id": ' || k || ', "academic_period": "' || year(ts)
                || CASE WHEN month(ts) <= 6 THEN '.1' ELSE '.2' END || '", "dificuldade": ' || (k % 5 + 1)
                || CASE WHEN k % 10 = 9 THEN '' ELSE ', "esforco": ' || ((k // 5) % 5 + 1) END
                || ', "passou": ' || CASE WHEN k % 7 = 0 THEN 'false' ELSE 'true' END
                || ', "result_count": ' || (k % 6) || ', "latency_ms": ' || floor(value * 10)::BIGINT
                || ', "action_type": "' || {pick(sample.ADMIN_ACTIONS, 'k % 3')} || '"'
                || CASE WHEN k % 13 = 12 THEN '' ELSE ', "docente": "' || {_TEACHER} || '"' END || '}}' AS payload,
            ts + to_seconds(CASE WHEN k >= 95 THEN k + 172800 ELSE k END) AS created_at
        FROM ek e LEFT JOIN cat USING (event_name)""",
    "deliveries": "SELECT * FROM ae UNION ALL SELECT * FROM ae WHERE created_at >= \"timestamp\" + INTERVAL 2 DAY",
    "usuarios": """SELECT c_custkey AS id_usuario, c_nationkey::BIGINT AS id_universidade,
            CASE WHEN c_custkey % 7 <> 6 THEN c_custkey % 100 END AS id_curso,
            CASE c_mktsegment WHEN 'MACHINERY' THEN 'Coordenador' WHEN 'BUILDING' THEN 'Admin' ELSE 'Aluno' END AS perfil,
            (DATE '2023-12-25' + (c_custkey % 20)::INTEGER)::DATE AS data_cadastro,
            CASE c_custkey % 10 WHEN 0 THEN 'inativo' WHEN 1 THEN 'pendente' ELSE 'ativo' END AS status
        FROM customer""",
    "disciplinas": """SELECT p_partkey AS id_disciplina, 'DISC' || p_partkey AS codigo_disciplina, p_name AS nome_disciplina,
            (p_partkey % 4 + 2)::INTEGER AS creditos, ((p_partkey % 4 + 2) * 15)::INTEGER AS ch_total FROM part""",
    "changes": """SELECT user_id, ts AS changed_at, event_id AS seq,
            CASE WHEN k % 4 = 3 THEN 'Coordenador' ELSE 'Aluno' END AS role,
            CASE WHEN k % 10 = 9 THEN 'pendente' ELSE 'ativo' END AS status
        FROM ek WHERE event_type = 'signup'""",
    "runs": f"""SELECT {sk("run_id")} AS run_sk, * FROM (
            SELECT 'run-' || strftime(d, '%Y%m%d') || '-' || stage AS run_id, 'load_events' AS dag_id, 'sample' AS lane, stage,
                d + to_minutes(60 + pos) AS start_time, d + to_minutes(60 + pos) + to_milliseconds(centis * 10) AS end_time,
                centis, n AS rows_extracted, CASE WHEN day(d) % 7 = 0 THEN 0 ELSE n END AS rows_loaded,
                CASE WHEN day(d) % 7 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
            FROM (SELECT d, n, 'extract' AS stage, 0 AS pos, n % 90 AS centis FROM per_day
                UNION ALL SELECT d, n, 'transform', 1, n % 170 FROM per_day
                UNION ALL SELECT d, n, 'quality', 2, n % 50 FROM per_day))""",
    "per_day": "SELECT date_trunc('day', ts)::TIMESTAMP AS d, count(*) AS n FROM events GROUP BY 1",
    "stg_e": f"""SELECT id AS raw_event_id, event_name, category, priority, schema_version, session_id, user_id, platform,
            app_version, screen_name, "timestamp" AS event_ts, payload AS payload_json, created_at,
            {dsk('"timestamp"')} AS event_date_sk FROM ae""",
    "stg_u": """SELECT id_usuario AS user_id, id_universidade AS university_id, id_curso AS course_id, perfil AS role,
            data_cadastro AS registration_date, status FROM usuarios""",
    "stg_d": """SELECT id_disciplina AS discipline_id, codigo_disciplina, nome_disciplina, creditos, ch_total FROM disciplinas""",
    "snap0": """SELECT *, registration_date::TIMESTAMP AS valid_from, NULL::TIMESTAMP AS valid_to FROM stg_u""",
    "d_users": f"""SELECT {sk("md5(user_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f'))")} AS user_sk, user_id,
            {sk('university_id')} AS university_sk, {sk('course_id')} AS course_sk, role, registration_date, status,
            valid_from, valid_to, valid_to IS NULL AS is_current FROM snap0""",
    "d_courses": f"SELECT {sk('discipline_id')} AS course_sk, * FROM stg_d",
    "d_univ": f"""SELECT DISTINCT {sk('university_id')} AS university_sk, university_id,
            CASE WHEN university_id = 1 THEN 'Universidade Federal de Viçosa' ELSE 'Universidade ' || university_id END AS name,
            CASE WHEN university_id = 1 THEN 'UFV' ELSE 'UNI' || university_id END AS acronym, 'MG' AS state FROM stg_u""",
    "d_screens": f"""SELECT {sk('screen_name')} AS screen_sk, screen_name, min(category) AS feature_key,
            '/' || replace(screen_name, '_', '/') AS route_path
        FROM stg_e WHERE screen_name IS NOT NULL GROUP BY screen_name""",
    "spellings": """SELECT DISTINCT payload_json->>'$.docente' AS raw,
            trim(regexp_replace(payload_json->>'$.docente', '\\s+', ' ', 'g')) AS clean
        FROM stg_e WHERE payload_json->>'$.docente' IS NOT NULL""",
    "d_prof": f"""SELECT {sk('clean')} AS professor_sk, clean AS docente_name_clean, min(raw) AS original_docente_string,
            count(*) AS name_variations FROM spellings GROUP BY clean""",
    "d_date": f"""SELECT {dsk('d')} AS date_sk, d AS full_date, year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter,
            month(d)::INTEGER AS month, strftime(d, '%B') AS month_name, isoyear(d)::INTEGER AS iso_year,
            weekofyear(d)::INTEGER AS week_of_year, isodow(d)::INTEGER AS day_of_week, isodow(d) IN (6, 7) AS is_weekend,
            true AS is_academic_term
        FROM (SELECT unnest(generate_series(date_trunc('year', lo)::TIMESTAMP,
                (date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d
            FROM (SELECT min(event_ts) AS lo, max(event_ts) AS hi FROM stg_e))""",
    "d_period": f"""SELECT {sk('p')} AS period_sk, p AS academic_period, year, semester FROM (
            SELECT DISTINCT year, CASE WHEN month < 7 THEN 1 ELSE 2 END::INTEGER AS semester,
                year || '.' || CASE WHEN month < 7 THEN 1 ELSE 2 END AS p FROM d_date)""",
    "fe": f"""SELECT {sk('e.raw_event_id')} AS event_sk, e.raw_event_id AS event_id, e.event_date_sk,
            coalesce(u.user_sk, {UNKNOWN_SK}) AS user_sk, s.screen_sk,
            coalesce({sk("coalesce(payload_json->>'$.course_id', payload_json->>'$.discipline_id')")}, u.course_sk) AS course_sk,
            p.professor_sk,
            {sk(f"coalesce(payload_json->>'$.academic_period', payload_json->>'$.ano_periodo', year(event_ts) || CASE WHEN month(event_ts) <= 6 THEN '.1' ELSE '.2' END)")} AS period_sk,
            e.session_id, e.platform, e.app_version, e.event_name, e.category, e.priority, e.schema_version, e.event_ts,
            e.payload_json
        FROM stg_e e
        LEFT JOIN d_users u ON u.user_id = e.user_id AND u.is_current
        LEFT JOIN d_screens s ON s.screen_name = e.screen_name
        LEFT JOIN d_prof p ON p.docente_name_clean = trim(regexp_replace(e.payload_json->>'$.docente', '\\s+', ' ', 'g'))""",
    "da": f"""SELECT {sk("g.date_sk || '-' || g.user_sk")} AS daily_activity_sk, g.date_sk, g.user_sk,
            coalesce(u.university_sk, {UNKNOWN_SK}) AS university_sk, 1::INTEGER AS is_active_day, session_count, events_count,
            ratings_submitted_count, downloads_count, uploads_count, has_completed_core_action
        FROM (SELECT event_date_sk AS date_sk, user_sk, count(DISTINCT session_id) AS session_count, count(*) AS events_count,
                count(*) FILTER (event_name IN ({names(C.RATING_EVENTS)})) AS ratings_submitted_count,
                count(*) FILTER (event_name = 'material_downloaded') AS downloads_count,
                count(*) FILTER (event_name = 'material_uploaded') AS uploads_count,
                bool_or(event_name IN ({names(C.CORE_ACTIONS)}))::INTEGER AS has_completed_core_action
            FROM fe GROUP BY ALL) g
        LEFT JOIN d_users u USING (user_sk)""",
    "fr": f"""SELECT event_sk AS rating_sk, event_id AS rating_id, event_date_sk AS date_sk, user_sk,
            coalesce(course_sk, {UNKNOWN_SK}) AS course_sk, professor_sk, coalesce(period_sk, {UNKNOWN_SK}) AS period_sk,
            coalesce(TRY_CAST(payload_json->>'$.dificuldade' AS INTEGER), 3) AS dificuldade,
            coalesce(TRY_CAST(payload_json->>'$.esforco' AS INTEGER), 3) AS esforco,
            CASE payload_json->>'$.passou' WHEN 'true' THEN 1 WHEN 'false' THEN 0 ELSE 1 END::INTEGER AS passou,
            event_ts AS rating_ts FROM fe WHERE event_name IN ({names(C.RATING_EVENTS)})""",
    "fs": f"""SELECT {sk('session_id')} AS session_sk, session_id, min(event_date_sk) AS session_start_date_sk,
            min(user_sk) AS user_sk, {seconds('min(event_ts)', 'max(event_ts)')} AS session_duration_seconds,
            count(DISTINCT screen_sk) AS screens_viewed_count, count(*) FILTER (category = 'Errors') AS errors_count,
            bool_or(event_name IN ({names(C.COLD_START_EVENTS)}))::INTEGER AS is_cold_start
        FROM fe GROUP BY session_id""",
    "act": f"SELECT user_sk, {day_of('date_sk')} AS activity_date, * EXCLUDE (user_sk) FROM da WHERE user_sk <> {UNKNOWN_SK}",
    "ev": f"SELECT *, {day_of('event_date_sk')} AS event_date FROM fe",
    "versions": """SELECT user_id, role, status, changed_at AS valid_from,
            lead(changed_at) OVER (PARTITION BY user_id ORDER BY changed_at) AS valid_to
        FROM (SELECT *, lag(role) OVER w AS r0, lag(status) OVER w AS s0, row_number() OVER w AS rn
            FROM (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY user_id, changed_at ORDER BY seq DESC) = 1)
            WINDOW w AS (PARTITION BY user_id ORDER BY changed_at))
        WHERE rn = 1 OR role <> r0 OR status <> s0""",
    "profiles": """SELECT u.* REPLACE (coalesce(c.role, u.perfil) AS perfil, coalesce(c.status, u.status) AS status)
        FROM usuarios u LEFT JOIN (SELECT * FROM changes
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY changed_at DESC, seq DESC) = 1) c
            ON c.user_id = u.id_usuario""",
    "marks": f"""SELECT activity_date, count(DISTINCT user_sk) AS dau,
            (SELECT count(DISTINCT b.user_sk) FROM act b WHERE b.activity_date BETWEEN a.activity_date - 6 AND a.activity_date) AS wau,
            (SELECT count(DISTINCT b.user_sk) FROM act b WHERE b.activity_date BETWEEN a.activity_date - 29 AND a.activity_date) AS mau
        FROM act a GROUP BY activity_date""",
    "user_sessions": f"""SELECT *, ntile(10) OVER (ORDER BY session_cnt DESC, user_sk) AS decile FROM (
            SELECT user_sk, count(*) AS session_cnt, sum(session_duration_seconds) AS secs
            FROM fs WHERE user_sk <> {UNKNOWN_SK} GROUP BY user_sk)""",
    "activation": f"""SELECT u.user_sk, u.registration_date, min(e.event_ts) AS activated_at,
            arg_min(e.event_name, (e.event_ts, e.event_id)) AS activated_by
        FROM d_users u LEFT JOIN fe e ON e.user_sk = u.user_sk AND e.event_ts >= u.registration_date
            AND e.event_name IN ({names(C.ACTIVATION_EVENTS)})
        GROUP BY ALL""",
}
