"""The check queries stated in SQL, independently of the library's dictionaries and plans."""

from checks.texts import PLACES, POLLUTANTS, STATES, UNITS


def _list(values: list) -> str:
    quoted = ["NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values]
    return "[" + ", ".join(quoted) + "]"


def _pick(values: list, position: str) -> str:
    return f"({_list(values)})[({position}) % {len(values)} + 1]"


_NAMES = [name for name, _ in POLLUTANTS]
_DIVISORS = "([" + ", ".join(str(d) for _, d in POLLUTANTS) + "]::DOUBLE[])"

_TEXTS = f"""
numbered AS (
    SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events
),
texts AS (
    SELECT event_id, user_id, event_type, k, ts,
        {_pick(_NAMES, "event_id")} AS pollutant,
        {_pick(_NAMES, "k")} AS pollutant_2,
        {_pick(UNITS, "k")} AS unit,
        {_pick(UNITS, "event_id")} AS unit_2,
        {_pick(STATES, "event_id + k")} AS state,
        {_pick(PLACES, "k")} AS location_name,
        CASE
            WHEN event_type = 'view' THEN date_trunc('day', ts)
            WHEN event_type = 'click' THEN date_trunc('hour', ts)
            WHEN event_type = 'signup' THEN date_trunc('hour', ts) - INTERVAL 8 HOUR
            WHEN event_type = 'purchase' THEN date_trunc('second', ts)
            WHEN k >= 80 THEN date_trunc('day', ts)
        END AS seen,
        CASE
            WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d')
            WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%dT%H:00:00Z')
            WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%dT%H:00:00+08:00')
            WHEN event_type = 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
            WHEN k < 30 THEN 'bad-date'
            WHEN k < 60 THEN NULL
            WHEN k < 80 THEN strftime(ts, '%H:%M')
            ELSE strftime(ts, '%Y-%m-%d')
        END AS date_text,
        CASE WHEN k NOT IN (7, 13) THEN value / {_DIVISORS}[event_id % {len(_NAMES)} + 1] END AS amount
    FROM numbered
)"""


def _key(x: str) -> str:
    return (
        f"regexp_replace(regexp_replace(lower(trim({x})), '[_-]+', ' ', 'g'), "
        r"'[ \t\n\x0B\f\r]+', ' ', 'g')"
    )


def _pollutant(x: str) -> str:
    return f"""CASE {_key(x)}
        WHEN 'co' THEN 'CO' WHEN 'carbon monoxide' THEN 'CO'
        WHEN 'no' THEN 'NO' WHEN 'nitric oxide' THEN 'NO'
        WHEN 'no2' THEN 'NO2' WHEN 'nitrogen dioxide' THEN 'NO2'
        WHEN 'o3' THEN 'O3' WHEN 'ozone' THEN 'O3'
        WHEN 'so2' THEN 'SO2' WHEN 'sulfur dioxide' THEN 'SO2' WHEN 'sulphur dioxide' THEN 'SO2'
        WHEN 'pm1' THEN 'PM1' WHEN 'pm10' THEN 'PM10' WHEN 'pm 10' THEN 'PM10'
        WHEN 'pm2.5' THEN 'PM2.5' WHEN 'pm25' THEN 'PM2.5' WHEN 'pm 2.5' THEN 'PM2.5'
        WHEN 'bc' THEN 'BC' WHEN 'black carbon' THEN 'BC'
        WHEN 'temperature' THEN 'TEMPERATURE'
        WHEN 'relativehumidity' THEN 'RELATIVE_HUMIDITY'
        WHEN 'relative humidity' THEN 'RELATIVE_HUMIDITY'
        WHEN 'humidity' THEN 'RELATIVE_HUMIDITY'
        WHEN 'um003' THEN 'PARTICLE_COUNT_0_3UM'
        ELSE upper(trim({x})) END"""


def _default_unit(pollutant: str) -> str:
    return f"""CASE
        WHEN {pollutant} IN ('CO', 'NO', 'NO2', 'O3', 'SO2') THEN 'ppm'
        WHEN {pollutant} IN ('PM1', 'PM2.5', 'PM10', 'BC') THEN 'ug/m3'
        WHEN {pollutant} = 'TEMPERATURE' THEN 'celsius'
        WHEN {pollutant} = 'RELATIVE_HUMIDITY' THEN 'percent'
        WHEN {pollutant} = 'PARTICLE_COUNT_0_3UM' THEN 'particles/cm3' END"""


def _unit(x: str, pollutant: str) -> str:
    key = (
        f"regexp_replace(replace(replace(replace(lower(trim({x})), 'µ', 'u'), 'μ', 'u'), "
        r"'m³', 'm3'), '[ \t\n\x0B\f\r]+', '', 'g')"
    )
    return f"""CASE
        WHEN {key} IN ('ug/m3', 'ugm-3', 'ugm3') THEN 'ug/m3'
        WHEN {key} IN ('ppm', 'ppmv') THEN 'ppm'
        WHEN {key} IN ('ppb', 'ppbv') THEN 'ppb'
        WHEN {key} IN ('%', 'percent', 'percentage') THEN 'percent'
        WHEN {key} IN ('c', 'celsius', 'degc') THEN 'celsius'
        WHEN {x} IS NULL OR {key} = '' THEN {_default_unit(pollutant)}
        ELSE {key} END"""


def _state(x: str) -> str:
    key = _key(x)
    title = f"""list_aggregate(list_transform(string_split({key}, ' '),
        lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')"""
    return f"""CASE
        WHEN {x} IS NULL OR {key} = '' THEN NULL
        WHEN {key} IN ('melaka', 'malacca') THEN 'Melaka'
        WHEN {key} IN ('negeri sembilan', 'n sembilan') THEN 'Negeri Sembilan'
        WHEN {key} IN ('penang', 'pulau pinang') THEN 'Pulau Pinang'
        WHEN {key} IN ('wp kuala lumpur', 'w.p. kuala lumpur',
            'wilayah persekutuan kuala lumpur', 'kl') THEN 'Kuala Lumpur'
        WHEN {key} IN ('wp labuan', 'w.p. labuan', 'wilayah persekutuan labuan') THEN 'Labuan'
        WHEN {key} IN ('wp putrajaya', 'w.p. putrajaya', 'wilayah persekutuan putrajaya')
            THEN 'Putrajaya'
        ELSE {title} END"""


def _place(x: str) -> str:
    key = rf"regexp_replace(lower(trim({x})), '[ \t\n\x0B\f\r]+', ' ', 'g')"
    return f"""CASE
        WHEN contains({key}, 'bukit bintang') OR contains({key}, 'klcc') OR contains({key}, 'ttdi')
            OR contains({key}, 'taman tun dr ismail') OR contains({key}, 'taman tun dr. ismail')
            THEN 'Kuala Lumpur'
        WHEN contains({key}, 'setia eco park') OR contains({key}, 'cyberjaya') THEN 'Selangor' END"""


def _bands(value: str, limits: list) -> str:
    labels = ["good", "moderate", "unhealthy_sensitive", "unhealthy", "very_unhealthy"]
    whens = " ".join(f"WHEN {value} <= {limit} THEN '{name}'" for limit, name in zip(limits, labels))
    return f"CASE {whens} ELSE 'hazardous' END"


def _risk(pollutant: str, value: str) -> str:
    return f"""CASE
        WHEN {value} IS NULL THEN 'unknown'
        WHEN {pollutant} = 'PM2.5' THEN {_bands(value, [12.0, 35.4, 55.4, 150.4, 250.4])}
        WHEN {pollutant} = 'PM10' THEN {_bands(value, [54.0, 154.0, 254.0, 354.0, 424.0])}
        WHEN {pollutant} = 'CO' THEN {_bands(value, [4.4, 9.4, 12.4, 15.4, 30.4])}
        WHEN {pollutant} = 'O3' THEN {_bands(value, [0.054, 0.070, 0.085, 0.105, 0.200])}
        WHEN {pollutant} = 'NO2' THEN {_bands(value, [0.053, 0.100, 0.360, 0.649, 1.249])}
        WHEN {pollutant} = 'SO2' THEN {_bands(value, [0.035, 0.075, 0.185, 0.304, 0.604])}
        ELSE 'unknown' END"""


def _date_parts(at: str) -> str:
    return f"""CAST({at} AS DATE) AS observed_date, CAST(year({at}) AS INTEGER) AS year,
        CAST(month({at}) AS INTEGER) AS month, CAST(day({at}) AS INTEGER) AS day"""


def _silver(canonical: str) -> str:
    """Valid rows of a canonical relation, one per reading, in the silver layout."""
    return f"""
    SELECT source, source_location_id, location_name, state, country, latitude, longitude, pollutant,
        unit, reading_value, observed_at, {_date_parts("observed_at")},
        {_risk("pollutant", "reading_value")} AS health_risk_category
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY source, source_location_id, location_name, pollutant, observed_at
            ORDER BY reading_value DESC NULLS LAST, state DESC NULLS LAST, country DESC NULLS LAST,
                latitude DESC NULLS LAST, longitude DESC NULLS LAST, unit DESC NULLS LAST
        ) AS nth
        FROM {canonical} WHERE observed_at IS NOT NULL AND pollutant IS NOT NULL
    ) WHERE nth = 1"""


def _daily(amount: str = "amount") -> str:
    canonical = f"""(
        SELECT 'opendosm' AS source, CAST(NULL AS VARCHAR) AS source_location_id,
            CAST(NULL AS VARCHAR) AS location_name, CAST(NULL AS VARCHAR) AS state,
            'Malaysia' AS country, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
            pollutant, {_default_unit("pollutant")} AS unit, reading_value, observed_at
        FROM (SELECT {_pollutant("pollutant")} AS pollutant, {amount} AS reading_value,
            seen AS observed_at FROM texts)
    )"""
    return _silver(canonical)


_RAW = f"""
raw AS (
    SELECT CASE WHEN k < 50 THEN 'opendosm' ELSE 'openaq' END AS source,
        CAST(k % 3 AS VARCHAR) AS source_location_id, location_name,
        coalesce({_state("state")}, {_place("location_name")}) AS state,
        CASE WHEN k % 5 <> 0 THEN 'Malaysia' END AS country,
        user_id / 100.0::DOUBLE AS latitude, k / 10.0::DOUBLE AS longitude,
        pollutant, {_unit("unit", "pollutant")} AS unit, amount AS reading_value, seen AS observed_at
    FROM (SELECT * REPLACE ({_pollutant("pollutant")} AS pollutant) FROM texts)
)"""

_STATION_TIME = """CASE
    WHEN event_type = 'error' AND k < 20 THEN NULL
    WHEN event_type IN ('view', 'click') THEN date_trunc('day', ts)
    ELSE date_trunc('hour', ts) END"""
_STATION_TEXT = """CASE
    WHEN event_type = 'error' AND k < 20 THEN NULL
    WHEN event_type IN ('view', 'click') THEN strftime(ts, '%Y-%m-%d')
    ELSE strftime(ts, '%Y-%m-%dT%H:00:00Z') END"""


def _sensors(pollutant: str, unit: str) -> str:
    return f"""
        SELECT CASE WHEN k % 10 <> 0 THEN CAST(user_id % 5 AS VARCHAR)
                ELSE CAST(user_id + 1000 AS VARCHAR) END AS source_location_id,
            location_name, state, CASE WHEN k % 5 <> 0 THEN 'Malaysia' END AS country,
            1 + user_id / 100.0::DOUBLE AS latitude,
            CASE WHEN k <> 3 THEN k / 10.0::DOUBLE END AS longitude,
            {pollutant} AS pollutant, {unit} AS unit,
            {_STATION_TIME} AS observed_at, {_STATION_TEXT} AS timestamp
        FROM texts WHERE k NOT IN (50, 51) AND NOT (event_type = 'signup' AND k < 15)"""


_SENSORS = f"""
sensors AS ({_sensors("pollutant", "unit")} UNION ALL {_sensors("pollutant_2", "unit_2")})"""

_STATION_CANONICAL = f"""(
    SELECT 'openaq' AS source, source_location_id, location_name,
        coalesce({_state("state")}, {_place("location_name")}) AS state, country, latitude, longitude,
        pollutant, {_unit("unit", "pollutant")} AS unit, CAST(NULL AS DOUBLE) AS reading_value,
        observed_at
    FROM (SELECT * REPLACE ({_pollutant("pollutant")} AS pollutant) FROM sensors)
)"""

_STATION_REST = f"""
    SELECT 'openaq' AS source, CASE WHEN k % 10 <> 0 THEN CAST(user_id % 5 AS VARCHAR)
            WHEN k <> 50 THEN CAST(user_id + 1000 AS VARCHAR) END AS source_location_id,
        CASE WHEN k NOT IN (50, 51) THEN location_name END AS location_name,
        CASE WHEN k NOT IN (50, 51) THEN state END AS state,
        CASE WHEN k NOT IN (50, 51) AND k % 5 <> 0 THEN 'Malaysia' END AS country,
        CASE WHEN k NOT IN (50, 51) THEN 1 + user_id / 100.0::DOUBLE END AS latitude,
        CASE WHEN k NOT IN (3, 50, 51) THEN k / 10.0::DOUBLE END AS longitude,
        CAST(NULL AS VARCHAR) AS pollutant, CAST(NULL AS VARCHAR) AS unit, CAST(NULL AS DOUBLE) AS reading_value,
        CASE WHEN k NOT IN (50, 51) THEN {_STATION_TEXT} END AS timestamp
    FROM texts WHERE k IN (50, 51) OR (event_type = 'signup' AND k < 15)"""

_STATION_EXPLODED = f"""
    SELECT 'openaq' AS source, source_location_id, location_name, state, country, latitude, longitude,
        pollutant, unit, CAST(NULL AS DOUBLE) AS reading_value, timestamp
    FROM sensors
    UNION ALL {_STATION_REST}"""

# A reading with the value one higher, as a later dump of the same records would hold it.
_LATER = "amount + 1"


def _with(select: str, *relations: str) -> str:
    return "WITH " + ",".join([_TEXTS, *relations]) + "\n" + select


def _pm25(select: str) -> str:
    pm25 = """pm25 AS (
        SELECT * FROM silver WHERE pollutant = 'PM2.5' AND reading_value IS NOT NULL
    )"""
    return _with(select, _RAW, f"silver AS ({_silver('raw')})", pm25)


def _gold(select: str) -> str:
    return _with(select, _RAW, f"silver AS ({_silver('raw')})")


_DAILY = _with(_daily())
_STATION = _with(_silver(_STATION_CANONICAL), _SENSORS)
_BOTH = _with(f"{_daily()} UNION ALL {_silver(_STATION_CANONICAL)}", _SENSORS)
_SHARED = _with(_silver("raw"), _RAW)

_CONCENTRATION = "CASE WHEN k = 7 THEN 'n/a' WHEN k <> 13 THEN CAST(k AS VARCHAR) END"

# Landed pages: a hundred events each, twenty pages a run, one event missing in the page that ends a run.
_PAGES = """pages AS (
    SELECT *, event_id // 100 AS page, event_id // 2000 AS run FROM texts WHERE event_id % 2000 <> 1001
), sizes AS (
    SELECT run, page, count(*) AS size, page % 20 * 100 AS "offset" FROM pages GROUP BY run, page
), ends AS (
    SELECT run, min("offset") AS last FROM sizes WHERE page % 11 <> 3 AND size < 100 GROUP BY run
), judged AS (
    SELECT sizes.*, page % 11 = 3 AS cut, page % 11 <> 3 AND coalesce("offset" > last, false) AS behind
    FROM sizes LEFT JOIN ends USING (run)
)"""

_SENSOR_REASON = """CASE WHEN timestamp IS NULL THEN 'missing date'
    WHEN pollutant IS NULL THEN 'missing pollutant' END"""

# The same events two months later.
_LATER_TEXTS = """later AS (
    SELECT * REPLACE (seen + INTERVAL 60 DAY AS seen) FROM texts
    UNION ALL SELECT * FROM texts
)"""

_NEWEST = f"""(
    SELECT 'opendosm' AS source, CAST(NULL AS VARCHAR) AS source_location_id,
        CAST(NULL AS VARCHAR) AS location_name, CAST(NULL AS VARCHAR) AS state,
        'Malaysia' AS country, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
        pollutant, {_default_unit("pollutant")} AS unit, reading_value, observed_at
    FROM (
        SELECT *, dump = max(dump) OVER (PARTITION BY pollutant, observed_at) AS newest FROM (
            SELECT {_pollutant("pollutant")} AS pollutant, amount + 1000 AS reading_value, seen AS observed_at, 1 AS dump
            FROM texts
            UNION ALL
            SELECT {_pollutant("pollutant")}, amount, seen, 2 FROM texts WHERE k % 2 = 0
        )
    ) WHERE newest
)"""

# Pages by month: a run's visits are parted by more than 20 days, 12 hours and 30 minutes without a page.
_RUNS = """
WITH pages AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS run, l_linenumber * 20 AS "offset", CAST(l_quantity AS INTEGER) AS size,
        l_shipdate + to_hours(l_linenumber) AS landed FROM lineitem
), steps AS (
    SELECT *, landed - lag(landed) OVER (PARTITION BY run ORDER BY landed) > INTERVAL '20 days 12 hours 30 minutes' AS apart FROM pages
), numbered AS (
    SELECT *, sum(CASE WHEN apart THEN 1 ELSE 0 END) OVER (PARTITION BY run ORDER BY landed) AS visit FROM steps
), visits AS (
    SELECT run, visit, max(landed) AS last_at, min("offset") FILTER (WHERE size < 20) AS last FROM numbered GROUP BY run, visit
)
SELECT run, "offset", size, CASE WHEN visit > 0 OR "offset" > last THEN 'after the end of the run' END AS reason
FROM numbered JOIN visits USING (run, visit)
WHERE last_at + INTERVAL '20 days 12 hours 30 minutes' <= (SELECT max(landed) FROM pages) - INTERVAL 5 DAY"""

ORACLE = {
    "document_roundtrip": _with(
        f"SELECT date_text AS date, pollutant, {_CONCENTRATION} AS concentration FROM texts"
    ),
    "land_daily": _with(
        f"""SELECT date_text AS date, pollutant, {_CONCENTRATION} AS concentration
        FROM pages JOIN judged USING (run, page) WHERE NOT cut AND NOT behind""",
        _PAGES,
    ),
    "rejected_pages_text": _with(
        """SELECT CAST(run AS VARCHAR) AS run, "offset",
            CASE WHEN cut THEN 'unreadable response' ELSE 'after the end of the run' END AS reason,
            CASE WHEN cut THEN '{"data": [{"date": "2024-' END AS raw
        FROM judged WHERE cut OR behind""",
        _PAGES,
    ),
    "land_stations": _with(_STATION_EXPLODED, _SENSORS).replace(
        "FROM numbered\n", "FROM numbered WHERE event_id // 100 % 13 <> 5\n"
    ),
    "rejected_stations": _with(
        f"""SELECT 'openaq' AS source, source_location_id, location_name, state, country, latitude, longitude,
            pollutant, unit, CAST(NULL AS DOUBLE) AS reading_value, timestamp, {_SENSOR_REASON} AS reason
        FROM sensors WHERE {_SENSOR_REASON} IS NOT NULL
        UNION ALL
        SELECT *, CASE WHEN latitude IS NULL THEN 'no results' ELSE 'no sensors' END FROM ({_STATION_REST})""",
        _SENSORS,
    ),
    "accepted_stations": _STATION,
    "stream_page_runs": _RUNS,
    "stream_dedupe": _with(_daily().replace("FROM texts)", "FROM later)"), _LATER_TEXTS),
    "newest_of_many": _with(_silver(_NEWEST)),
    "schema_drift": """
        SELECT 'batch' AS field, 'BIGINT' AS type, count(*) AS records FROM events
        UNION ALL SELECT 'note', 'STRING', count(*) FROM events WHERE event_type = 'view'
        UNION ALL SELECT 'user', 'OBJECT<id: BIGINT>', count(*) FROM events WHERE event_type = 'click'""",
    "variant_fields": _with(
        f"""SELECT date_text AS date, pollutant, {_CONCENTRATION} AS concentration,
            'batch=' || k || CASE WHEN event_type = 'click' THEN ',user={{"id":' || user_id || '}}'
                WHEN event_type = 'view' THEN ',note="x"' ELSE '' END AS further FROM texts"""
    ),
    "alias_table": _with(f"SELECT event_id, {_pollutant('pollutant')} AS pollutant FROM texts"),
    "place_hints_table": _with(f"SELECT event_id, {_place('location_name')} AS state FROM texts"),
    "summary_refresh": _gold(
        """SELECT state, year, month, pollutant, unit, round(avg(reading_value), 9) AS mean_value,
            min(reading_value) AS min_value, max(reading_value) AS max_value,
            count(reading_value) AS readings
        FROM silver GROUP BY state, year, month, pollutant, unit"""
    ),
    "pollutant_quantiles": _gold(
        """SELECT pollutant, rank, count(reading_value) AS readings, true AS within
        FROM silver, (VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE)) AS ranks(rank)
        WHERE reading_value IS NOT NULL GROUP BY pollutant, rank"""
    ),
    "pollutant_canonical": _with(
        f"SELECT event_id, {_pollutant('pollutant')} AS pollutant FROM texts"
    ),
    "unit_canonical": _with(f"SELECT event_id, {_unit('unit', 'pollutant')} AS unit FROM texts"),
    "pollutant_and_unit": _with(
        f"""SELECT event_id, pollutant, {_unit('unit', 'pollutant')} AS unit
        FROM (SELECT event_id, unit, {_pollutant('pollutant')} AS pollutant FROM texts)"""
    ),
    "unit_defaults": _with(
        f"""SELECT event_id, {_default_unit('pollutant')} AS unit
        FROM (SELECT event_id, {_pollutant('pollutant')} AS pollutant FROM texts)"""
    ),
    "state_canonical": _with(f"SELECT event_id, {_state('state')} AS state FROM texts"),
    "state_from_place": _with(f"SELECT event_id, {_place('location_name')} AS state FROM texts"),
    "state_column": _with(
        f"""SELECT event_id, coalesce({_state('state')}, {_place('location_name')}) AS state
        FROM texts"""
    ),
    "time_columns": _with(f"SELECT event_id, seen AS observed_at, {_date_parts('seen')} FROM texts"),
    "risk_category": _with(
        f"""SELECT event_id, pollutant, amount AS reading_value,
            {_risk('pollutant', 'amount')} AS health_risk_category
        FROM (SELECT event_id, amount, {_pollutant('pollutant')} AS pollutant FROM texts)"""
    ),
    "threshold_label": f"""SELECT event_id, CASE WHEN value IS NULL THEN 'hazardous'
        ELSE {_bands('value', [5, 20, 50, 100, 200])} END AS label FROM events""",
    "dedupe_readings": _with(
        """SELECT source, source_location_id, location_name, pollutant, observed_at, unit, reading_value
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY source, source_location_id, location_name, pollutant, observed_at
                ORDER BY reading_value DESC NULLS LAST, unit DESC NULLS LAST
            ) AS nth
            FROM (
                SELECT event_type AS source, CAST(k % 3 AS VARCHAR) AS source_location_id,
                    location_name, pollutant, seen AS observed_at, unit, amount AS reading_value
                FROM texts
            )
        ) WHERE nth = 1"""
    ),
    "valid_rows": _with(
        """SELECT event_id, pollutant, CAST(seen AS DATE) AS observed_date FROM texts
        WHERE seen IS NOT NULL AND pollutant IS NOT NULL"""
    ),
    "rejected_rows": _with(
        """SELECT * FROM (
            SELECT date_text AS date, pollutant,
                CASE WHEN k = 7 THEN 'n/a' END AS concentration,
                CASE WHEN pollutant IS NULL THEN 'missing pollutant'
                    WHEN date_text IS NULL THEN 'missing date'
                    WHEN seen IS NULL THEN 'unreadable date'
                    WHEN k = 7 THEN 'unreadable value' END AS reason
            FROM texts
        ) WHERE reason IS NOT NULL"""
    ),
    "daily_rows": _with(
        """SELECT 'opendosm' AS source, CAST(NULL AS VARCHAR) AS source_location_id,
            CAST(NULL AS VARCHAR) AS location_name, CAST(NULL AS VARCHAR) AS state,
            'Malaysia' AS country, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
            pollutant, CAST(NULL AS VARCHAR) AS unit, amount AS reading_value, date_text AS date
        FROM texts"""
    ),
    "daily_silver": _DAILY,
    "shared_clean": _SHARED,
    "station_exploded": _with(_STATION_EXPLODED, _SENSORS),
    "station_silver": _STATION,
    "both_sources": _BOTH,
    "ordered_readings": _DAILY,
    "silver_roundtrip": _SHARED,
    "silver_day_range": _with(
        f"""SELECT * FROM ({_silver('raw')})
        WHERE observed_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-15'""",
        _RAW,
    ),
    "overwrite_two_sources": _with(
        f"{_daily(_LATER)} UNION ALL {_silver(_STATION_CANONICAL)}", _SENSORS
    ),
    "merge_silver": _SHARED,
    "partitioned_write": "SELECT * FROM orders",
    "json_roundtrip": _with(
        """SELECT date_text AS date, pollutant,
            CASE WHEN k = 7 THEN 'n/a' WHEN k <> 13 THEN CAST(k AS VARCHAR) END AS concentration
        FROM texts"""
    ),
    "latest_snapshot": _with(
        "SELECT date_text AS date, pollutant, CAST(event_id + 1 AS VARCHAR) AS concentration FROM texts"
    ),
    "page_flatten": _with(
        """SELECT date_text AS date, pollutant,
            CASE WHEN k = 7 THEN 'n/a' WHEN k <> 13 THEN CAST(k AS VARCHAR) END AS concentration
        FROM texts, unnest(CASE WHEN event_type IN ('view', 'click') THEN [1, 2]
            WHEN event_type = 'signup' THEN [1] ELSE [] END)"""
    ),
    "page_rejects": _with(
        """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS run, event_id AS "offset"
        FROM texts WHERE event_id % 50 = 3"""
    ),
    "page_readable": _with(
        """SELECT date_text AS date, pollutant,
            CASE WHEN k = 7 THEN 'n/a' WHEN k <> 13 THEN CAST(k AS VARCHAR) END AS concentration
        FROM texts, unnest(CASE WHEN event_type IN ('view', 'click') THEN [1, 2]
            WHEN event_type = 'signup' THEN [1] ELSE [] END)
        WHERE event_id % 50 <> 3"""
    ),
    "indented_roundtrip": _with(
        """SELECT coalesce(date_text, '-') AS date, coalesce(pollutant, '-') AS pollutant,
            coalesce(CASE WHEN k = 7 THEN 'n/a' WHEN k <> 13 THEN CAST(k AS VARCHAR) END, '-') AS concentration
        FROM texts"""
    ),
    "observed_count": _with(f"SELECT count(*) AS readings FROM ({_silver('raw')})", _RAW),
    "optional_columns": _with(
        f"""SELECT event_id, {_default_unit('pollutant')} AS unit, state
        FROM (SELECT event_id, {_pollutant('pollutant')} AS pollutant, {_place('location_name')} AS state FROM texts)"""
    ),
    "page_complete": """
        WITH sized AS (
            SELECT l_orderkey AS run, l_linenumber * 20 AS "offset", CAST(l_quantity AS INTEGER) AS size
            FROM lineitem
        ), ends AS (
            SELECT run, min("offset") AS last FROM sized WHERE size < 20 GROUP BY run
        )
        SELECT sized.run, sized."offset", sized.size FROM sized LEFT JOIN ends USING (run)
        WHERE last IS NULL OR sized."offset" <= last""",
    "key_tagging": """SELECT regexp_extract(url, '/([0-9]+)', 1) AS location_id, page_id,
            CAST(length(html) AS INTEGER) AS chars FROM pages""",
    "trailing_range": """SELECT event_id, ts AS observed_at FROM events
        WHERE ts BETWEEN TIMESTAMP '2023-12-16 12:00:00' AND TIMESTAMP '2024-01-15 12:00:00'""",
    "reading_count": _with(f"SELECT count(*) AS readings FROM ({_silver('raw')})", _RAW),
    "ingest_job": _DAILY,
    "full_run": _BOTH,
    "stream_ingest": _DAILY,
    "state_monthly": _gold(
        """SELECT state, year, month, pollutant, unit, round(avg(reading_value), 9) AS mean_value,
            min(reading_value) AS min_value, max(reading_value) AS max_value,
            count(reading_value) AS readings
        FROM silver GROUP BY state, year, month, pollutant, unit"""
    ),
    "risk_summary": _gold(
        """SELECT pollutant, health_risk_category, count(*) AS readings,
            round(count(*) / sum(count(*)) OVER (PARTITION BY pollutant), 9) AS share
        FROM silver GROUP BY pollutant, health_risk_category"""
    ),
    "haze_trend": _pm25(
        """SELECT state, observed_date, round(daily_mean, 9) AS daily_mean,
            round(avg(daily_mean) OVER (
                PARTITION BY state ORDER BY observed_date
                RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 9) AS trailing_mean,
            round(daily_mean - lag(daily_mean) OVER (
                PARTITION BY state ORDER BY observed_date), 9) AS change
        FROM (SELECT state, observed_date, avg(reading_value) AS daily_mean
            FROM pm25 GROUP BY state, observed_date)"""
    ),
    "state_mean_pm25": _pm25(
        "SELECT state, round(avg(reading_value), 9) AS mean_pm25 FROM pm25 GROUP BY state"
    ),
}
