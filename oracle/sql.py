"""DuckDB SQL for the registered queries, from the events table up.

``STAGES`` is a chain of common table expressions; ``upto(stage, select)`` prefixes a select with
the chain up to a stage. Numbers are written as doubles (``4e1``), 32-bit columns are cast to REAL
where the engine keeps them so, and ``rnd`` rounds halves away from zero on the decimal value.
"""

from __future__ import annotations

from tailwake import constants as K
from tailwake import schemas as S
from tailwake.plans import training
from tailwake.plans.serving import IMPACT_COLUMNS, RIPPLE_COLUMNS
from tailwake.sources import events as E


def rnd(value: str, digits: int = 1) -> str:
    return f"CAST(round(CAST(({value}) AS DECIMAL(38, 12)), {digits}) AS DOUBLE)"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _rows(rows) -> str:
    def cell(v):
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v!r}"

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


def _real_double(text: str) -> str:
    return f"CAST({text} AS DOUBLE)"


LAT = "(event_id * 37 % 1700) / 1e2 - 11"
LON = "(event_id * 53 % 4600) / 1e2 + 95"
RAIN = "CAST(CASE WHEN NOT (event_type = 'error' AND k % 10 = 0) THEN k * 6 / 1e1 END AS REAL)"
WIND = "CAST((event_id * 13 % 700) / 1e1 AS REAL)"
SIGHT = "CAST(event_id * 29 % 16000 AS REAL)"
CODE = f"CAST({_list(E.WEATHER_CODES)}[k % 10 + 1] AS INTEGER)"

_SEATS = " ".join(f"WHEN '{m}' THEN {n}" for m, n in K.AIRCRAFT_CAPACITY.items())


def band(x: str) -> str:
    return (
        f"CASE WHEN {x} <= 25 THEN 'LOW' WHEN {x} <= 50 THEN 'MODERATE' "
        f"WHEN {x} <= 75 THEN 'HIGH' ELSE 'CRITICAL' END"
    )


def category(x: str) -> str:
    return (
        f"CASE WHEN {x} < 15 THEN 'ON TIME' WHEN {x} <= 60 THEN 'MEDIUM DELAY' "
        "ELSE 'CRITICAL DELAY' END"
    )


def _impact(minutes: str, source: str) -> str:
    """Delay, capacity, index and compensation of ``source`` for a delay expression."""
    return f"""
        SELECT *,
            {band("fdi")} AS fdi_category,
            CAST(CASE WHEN predicted_delay_minutes < 180 THEN 0
                      WHEN distance_km < 1500 THEN affected_passengers * 250
                      WHEN distance_km < 3500 THEN affected_passengers * 400
                      ELSE affected_passengers * 600 END AS INTEGER)
                AS estimated_compensation_eur
        FROM (
            SELECT *,
                CAST(floor(capacity * 0.85 + 0.5) AS INTEGER) AS affected_passengers,
                CAST(CAST(normalized_delay AS DOUBLE) * 4e1
                    + CAST(weather_score AS DOUBLE) * 25e0
                    + traffic_density / 1e1 * 15e0
                    + least(CAST(route_deviation AS DOUBLE) / 5e1, 1e0) * 1e1
                    + is_peak_hour * 1e1 AS REAL) AS fdi
            FROM (
                SELECT *,
                    {category("predicted_delay_minutes")} AS delay_category,
                    -1 AS spatial_cluster,
                    CASE aircraft_model {_SEATS} ELSE {K.DEFAULT_CAPACITY} END AS capacity,
                    CAST(least(CAST(predicted_delay_minutes AS DOUBLE) / 18e1, 1e0) AS REAL)
                        AS normalized_delay
                FROM (SELECT *, {minutes} AS predicted_delay_minutes FROM {source})
            )
        )"""


_LIVE_SELECT = ", ".join(f"{src} AS {name}" for name, src in S.LIVE_COLUMNS.items())


def _latest(source: str) -> str:
    return f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY flight_id ORDER BY timestamp DESC, updated_at DESC) AS rn
            FROM {source}) WHERE rn = 1"""


STAGES = {
    "ev": """
        SELECT event_id, user_id, event_type, value,
            CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
            CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 86400
                + extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60
                + floor(extract(second FROM ts)) AS BIGINT) AS timestamp,
            strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS ingested_at
        FROM events""",
    "blocked": f"""
        SELECT *, timestamp // {E.BLOCK_S} AS block,
            CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN ''
                 ELSE {_list(E.AIRLINES)}[user_id % 10 + 1] END AS airline_icao
        FROM ev""",
    "reports": f"""
        SELECT 'F' || user_id || '-' || block AS flight_id,
            coalesce(airline_icao, '') || k AS callsign,
            airline_icao,
            CASE WHEN event_id % 61 <> 0
                 THEN {_list(E.MODELS)}[user_id * 7 % 12 + 1] END AS aircraft_model,
            CASE WHEN event_id % 41 = 0 THEN ''
                 ELSE 'PK-' || lpad(CAST(user_id AS VARCHAR), 5, '0') END AS registration,
            CASE WHEN event_id % 67 = 0 THEN '' WHEN event_id % 71 = 0 THEN NULL
                 ELSE {_list(E.AIRPORTS)}[(user_id + block) % 12 + 1] END AS origin,
            CASE WHEN event_id % 73 <> 0
                 THEN {_list(E.AIRPORTS)}[(user_id + block * 5 + 3) % 12 + 1] END AS destination,
            CASE WHEN event_id % 101 <> 0 THEN {LAT} END AS latitude,
            {LON} AS longitude,
            CAST(event_id * 7919 % 62000 AS INTEGER) AS altitude_ft,
            CAST(event_id * 7877 % 760 AS INTEGER) AS speed_kn,
            CAST(event_id * 31 % 366 AS INTEGER) AS heading_deg,
            CASE WHEN event_id % 97 <> 0 THEN event_id % 20 = 0 END AS on_ground,
            timestamp, ingested_at,
            {RAIN} AS precipitation_mm, {WIND} AS wind_knots, {SIGHT} AS visibility_m,
            {CODE} AS weather_code,
            CAST(floor(value * 6) / 1e1 - 10 AS REAL) AS given_delay
        FROM blocked""",
    "clean": """
        SELECT * REPLACE (
            coalesce(airline_icao, 'UNKNOWN') AS airline_icao,
            coalesce(aircraft_model, 'UNKNOWN') AS aircraft_model,
            coalesce(origin, 'UNKNOWN') AS origin,
            coalesce(destination, 'UNKNOWN') AS destination,
            coalesce(precipitation_mm, CAST(0 AS REAL)) AS precipitation_mm,
            coalesce(wind_knots, CAST(0 AS REAL)) AS wind_knots,
            coalesce(visibility_m, CAST(10000 AS REAL)) AS visibility_m,
            coalesce(weather_code, 0) AS weather_code)
        FROM reports
        WHERE flight_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
            AND on_ground = FALSE AND altitude_ft BETWEEN 1000 AND 60000
            AND speed_kn BETWEEN 50 AND 700 AND heading_deg BETWEEN 0 AND 360""",
    "timed": """
        SELECT *, CAST(timestamp // 3600 % 24 AS INTEGER) AS hour_utc,
            CAST((timestamp // 86400 + 4) % 7 + 1 AS INTEGER) AS day_of_week,
            DATE '1970-01-01' + CAST(timestamp // 86400 AS INTEGER) AS report_date
        FROM clean""",
    "flagged": """
        SELECT *,
            CAST(precipitation_mm > 0.5 AS INTEGER) AS is_raining,
            CAST(wind_knots > 25 AS INTEGER) AS is_high_wind,
            CAST(visibility_m < 3000 AS INTEGER) AS is_low_visibility,
            CAST(weather_code BETWEEN 60 AND 99 AS INTEGER) AS is_bad_weather,
            CASE WHEN altitude_ft < 15000 THEN 0 WHEN altitude_ft < 35000 THEN 1 ELSE 2 END
                AS flight_phase,
            CAST(speed_kn < 200 AS INTEGER) AS is_slow,
            CASE WHEN altitude_ft > 0 THEN speed_kn / altitude_ft * 1000 ELSE 0e0 END
                AS speed_altitude_ratio,
            CAST(hour_utc BETWEEN 6 AND 9 OR hour_utc BETWEEN 17 AND 20 AS INTEGER)
                AS is_peak_hour,
            CAST(day_of_week IN (1, 7) AS INTEGER) AS is_weekend
        FROM timed""",
    "featured": """
        SELECT *,
            CAST(least(1e0,
                least(CAST(precipitation_mm AS DOUBLE) / 5e1, 1e0) * 3e-1
                + least(CAST(wind_knots AS DOUBLE) / 6e1, 1e0) * 25e-2
                + greatest(0e0, 1e0 - CAST(visibility_m AS DOUBLE) / 15e3) * 25e-2
                + CASE WHEN weather_code >= 80 THEN 1e0 WHEN weather_code >= 60 THEN 6e-1
                       WHEN weather_code >= 40 THEN 3e-1 ELSE 0e0 END * 2e-1) AS REAL)
                AS weather_score,
            CAST(speed_kn * 1852e-3 * CASE WHEN altitude_ft > 30000 THEN 35e-1
                WHEN altitude_ft > 20000 THEN 2e0 ELSE 1e0 END AS REAL) AS distance_km,
            CAST(CAST(wind_knots AS DOUBLE) * CASE WHEN wind_knots > 30 THEN 3e-1 ELSE 1e-1 END
                + CASE WHEN weather_code >= 60 THEN 5e0 ELSE 0e0 END AS REAL) AS route_deviation,
            CASE WHEN hour_utc BETWEEN 6 AND 9 THEN 8 WHEN hour_utc BETWEEN 17 AND 20 THEN 9
                 WHEN hour_utc BETWEEN 10 AND 16 THEN 6 ELSE 3 END
                + CASE WHEN day_of_week BETWEEN 2 AND 6 THEN 1 ELSE 0 END AS traffic_density,
            is_raining * 2e0 + is_high_wind * 25e-1 + is_low_visibility * 3e0
                + is_bad_weather * 2e0 + is_peak_hour * 15e-1 + is_weekend * 5e-1
                + is_slow * 1e0 AS risk_score_manual
        FROM flagged""",
    "ruled": _impact(f"CAST({rnd('risk_score_manual * 6e0')} AS REAL)", "featured"),
    "enriched": _impact("given_delay", "featured"),
    "live_rows": f"SELECT {_LIVE_SELECT} FROM enriched",
    "live": _latest("live_rows"),
    "legs": f"""
        SELECT f.flight_id,
            count(g.flight_id) AS downstream_flight_count,
            min(g.timestamp) AS next_timestamp,
            first(g.flight_id ORDER BY g.timestamp, g.flight_id) AS next_flight_id
        FROM live f LEFT JOIN live g
            ON f.registration <> '' AND g.registration = f.registration
            AND g.timestamp > f.timestamp
            AND g.timestamp <= f.timestamp + {K.ROTATION_HORIZON_S}
        GROUP BY f.flight_id""",
    "onward": """
        SELECT f.*, g.next_flight_id, g.next_timestamp, g.downstream_flight_count,
            CAST((g.next_timestamp - f.timestamp) // 60 AS INTEGER) AS next_flight_gap_min
        FROM live f JOIN legs g USING (flight_id)""",
    "ripple": f"""
        SELECT *, {band("res")} AS res_category FROM (
            SELECT *, {rnd(f'''greatest(0e0, least(1e2,
                CASE WHEN next_flight_gap_min IS NULL THEN 0e0
                     WHEN next_flight_gap_min < 60 THEN 1e2 WHEN next_flight_gap_min < 120 THEN 75e0
                     WHEN next_flight_gap_min < 180 THEN 5e1 WHEN next_flight_gap_min < 300 THEN 25e0
                     ELSE 1e1 END * 3e-1
                + CASE WHEN downstream_flight_count >= 5 THEN 1e2
                       WHEN downstream_flight_count >= 3 THEN 66e0
                       WHEN downstream_flight_count >= 1 THEN 33e0 ELSE 0e0 END * 2e-1
                + CASE WHEN destination IN {_in(K.HUB_AIRPORTS)} THEN 1e2 ELSE 3e1 END * 2e-1
                + least(CAST(predicted_delay_minutes AS DOUBLE) / 12e1, 1e0) * 1e2 * 15e-2
                + CASE WHEN hour_utc BETWEEN 0 AND 5 THEN 1e2
                       WHEN hour_utc BETWEEN 6 AND 9 OR hour_utc BETWEEN 17 AND 20 THEN 75e0
                       WHEN hour_utc BETWEEN 21 AND 23 THEN 5e1 ELSE 25e0 END * 1e-1
                + CAST(fdi AS DOUBLE) * 5e-2))''')} AS res
            FROM onward)""",
    "totals": """
        SELECT airline AS airline_icao, count(*) AS total_flights,
            count(*) FILTER (delay_category = 'ON TIME') / CAST(count(*) AS DOUBLE) AS on_time,
            count(*) FILTER (delay_category = 'CRITICAL DELAY') / CAST(count(*) AS DOUBLE)
                AS critical,
            count(*) FILTER (fdi_category IN ('HIGH', 'CRITICAL')) / CAST(count(*) AS DOUBLE)
                AS high_fdi,
            count(*) FILTER (res_category IN ('HIGH', 'CRITICAL')) / CAST(count(*) AS DOUBLE)
                AS high_res,
            avg(CAST(predicted_delay_minutes AS DOUBLE)) AS delay,
            avg(CAST(fdi AS DOUBLE)) AS fdi, avg(res) AS res,
            CAST(sum(affected_passengers) AS BIGINT) AS total_affected_passengers,
            CAST(sum(estimated_compensation_eur) AS BIGINT) AS total_estimated_compensation_eur
        FROM ripple WHERE airline <> '' GROUP BY airline""",
    "performance": f"""
        SELECT *, CASE WHEN api_score >= 80 THEN 'EXCELLENT' WHEN api_score >= 60 THEN 'GOOD'
                       WHEN api_score >= 40 THEN 'FAIR' ELSE 'POOR' END AS api_category
        FROM (
            SELECT airline_icao, total_flights,
                {rnd("on_time * 100")} AS on_time_rate,
                {rnd("critical * 100")} AS critical_delay_rate,
                {rnd("high_fdi * 100")} AS high_fdi_rate,
                {rnd("high_res * 100")} AS high_res_rate,
                {rnd("delay")} AS avg_delay_minutes, {rnd("fdi")} AS avg_fdi,
                {rnd("res")} AS avg_res,
                total_affected_passengers, total_estimated_compensation_eur,
                {rnd('''greatest(0e0, least(1e2, on_time * 4e1
                    + (1e0 - least(delay / 12e1, 1e0)) * 25e0 + (1e0 - critical) * 2e1
                    + (1e0 - least(fdi / 1e2, 1e0)) * 1e1
                    + (1e0 - least(res / 1e2, 1e0)) * 5e0))''')} AS api_score
            FROM totals)""",
}


def upto(stage: str, select: str, extra: dict[str, str] | None = None) -> str:
    chain = {}
    for name, body in STAGES.items():
        chain[name] = body
        if name == stage:
            break
    chain.update(extra or {})
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in chain.items()) + "\n" + select


ROW = "flight_id, ingested_at"
BRONZE = ", ".join(S.BRONZE_COLUMNS)
SILVER = ", ".join(S.SILVER_COLUMNS)
LIVE = ", ".join(S.LIVE_COLUMNS)
SENT = "timestamp % 89 <> 0"  # messages that are valid JSON

# --- weather readings and the as-of join ---
WEATHER_STAGES = {
    "readings": f"""
        SELECT CAST(round_even({LAT}, 0) AS INTEGER) AS cell_lat,
            CAST(round_even({LON}, 0) AS INTEGER) AS cell_lon,
            timestamp - event_id * 97 % 3600 AS observed_at,
            event_id % 4 = 3 AS fallback,
            {RAIN} AS precipitation_mm,
            CASE WHEN event_id % 4 = 3 THEN CAST(CAST({WIND} AS DOUBLE) / 1852e-3 AS REAL)
                 ELSE {WIND} END AS wind_knots,
            {SIGHT} AS visibility_m, {CODE} AS weather_code
        FROM ev""",
    "best": """
        SELECT * FROM readings QUALIFY row_number() OVER (
            PARTITION BY cell_lat, cell_lon, observed_at
            ORDER BY fallback, precipitation_mm NULLS FIRST, wind_knots, visibility_m,
                weather_code) = 1""",
    "intervals": f"""
        SELECT *, least(observed_at + {K.WEATHER_TTL_S}, lead(observed_at) OVER (
            PARTITION BY cell_lat, cell_lon ORDER BY observed_at)) AS valid_to
        FROM best""",
}


def _asof(source: str, columns: str) -> str:
    return f"""SELECT {columns}, i.precipitation_mm, i.wind_knots, i.visibility_m, i.weather_code
        FROM {source} r LEFT JOIN intervals i
            ON i.cell_lat = CAST(round_even(r.latitude, 0) AS INTEGER)
            AND i.cell_lon = CAST(round_even(r.longitude, 0) AS INTEGER)
            AND r.timestamp >= i.observed_at AND r.timestamp < i.valid_to"""


# --- raw feed ---
FEED = f"""
    SELECT 'F' || user_id || '-' || event_id AS flight_id,
        CASE WHEN event_id % 7 = 0 THEN 'N' ELSE {_list(E.AIRLINES)}[user_id % 10 + 1] END || k
            AS callsign,
        CASE WHEN event_id % 11 = 0 THEN '' ELSE {_list(E.AIRLINES)}[user_id % 10 + 1] END
            AS airline_icao,
        CASE WHEN event_id % 61 = 0 THEN '' ELSE {_list(E.MODELS)}[user_id * 7 % 12 + 1] END
            AS aircraft_model,
        'PK-' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS registration,
        {_list(E.AIRPORTS)}[user_id % 12 + 1] AS origin,
        {_list(E.AIRPORTS)}[(user_id + 5) % 12 + 1] AS destination,
        {LAT} AS latitude, {LON} AS longitude,
        CAST(event_id * 7919 % 62000 AS INTEGER) AS altitude_ft,
        CAST(event_id * 7877 % 760 AS INTEGER) AS speed_kn,
        CAST(event_id * 31 % 366 AS INTEGER) AS heading_deg,
        FALSE AS on_ground, timestamp, ingested_at
    FROM ev
    WHERE event_id % 43 <> 0 AND event_id % 47 <> 0 AND event_id % 31 <> 0
        AND event_id % 37 <> 0 AND event_id % 20 <> 0"""

# --- gold ---
MEAN_DELAY = rnd("avg(CAST(predicted_delay_minutes AS DOUBLE))")


def _percent(condition: str) -> str:
    return rnd(f"count(*) FILTER ({condition}) / CAST(count(*) AS DOUBLE) * 100")


def _avg(name: str, digits: int) -> str:
    return rnd(f"avg(CAST({name} AS DOUBLE))", digits)


def gold_airline(where: str = "") -> str:
    return f"""SELECT report_date, airline_icao, count(*) AS total_flights,
        {MEAN_DELAY} AS avg_delay_minutes,
        CAST({rnd("max(CAST(predicted_delay_minutes AS DOUBLE))")} AS REAL) AS max_delay_minutes,
        count(*) FILTER (delay_category = 'ON TIME') AS on_time_count,
        count(*) FILTER (delay_category = 'MEDIUM DELAY') AS medium_delay_count,
        count(*) FILTER (delay_category = 'CRITICAL DELAY') AS critical_delay_count,
        {_avg("fdi", 1)} AS avg_fdi,
        CAST(sum(affected_passengers) AS BIGINT) AS total_affected_passengers,
        CAST(sum(estimated_compensation_eur) AS BIGINT) AS total_compensation_eur,
        {_percent("delay_category = 'ON TIME'")} AS on_time_percentage
        FROM enriched {where} GROUP BY report_date, airline_icao"""


GOLD = {
    "airline_daily_performance": gold_airline(),
    "route_daily_statistics": f"""SELECT report_date, origin, destination,
        count(*) AS total_flights, {MEAN_DELAY} AS avg_delay_minutes,
        {_avg("weather_score", 3)} AS avg_weather_score,
        {_avg("traffic_density", 1)} AS avg_traffic_density,
        count(*) FILTER (delay_category = 'CRITICAL DELAY') AS critical_delay_count,
        {_avg("distance_km", 1)} AS avg_distance_km
        FROM enriched WHERE origin NOT IN ('', 'UNKNOWN') AND destination NOT IN ('', 'UNKNOWN')
        GROUP BY report_date, origin, destination""",
    "hourly_delay_trends": f"""SELECT report_date, hour_utc, count(*) AS total_flights,
        {MEAN_DELAY} AS avg_delay_minutes,
        {_percent("delay_category IN ('MEDIUM DELAY', 'CRITICAL DELAY')")} AS delayed_percentage,
        {_avg("weather_score", 3)} AS avg_weather_score,
        {_avg("traffic_density", 1)} AS avg_traffic_density
        FROM enriched GROUP BY report_date, hour_utc""",
    "weather_impact_analysis": f"""SELECT report_date,
        CASE WHEN weather_score < 0.2 THEN 'CLEAR' WHEN weather_score < 0.5 THEN 'MODERATE'
             ELSE 'SEVERE' END AS weather_bucket,
        count(*) AS total_flights, {MEAN_DELAY} AS avg_delay_minutes,
        {_avg("fdi", 1)} AS avg_fdi,
        {_percent("delay_category = 'CRITICAL DELAY'")} AS critical_percentage,
        {_avg("route_deviation", 2)} AS avg_route_deviation
        FROM enriched GROUP BY ALL""",
}

DELAYED = "delay_category IN ('MEDIUM DELAY', 'CRITICAL DELAY')"
BATCH_STATS = f"""SELECT count(*) AS total_flights,
    count(*) FILTER ({DELAYED}) AS delayed_flights,
    count(*) FILTER (delay_category = 'CRITICAL DELAY') AS critical_flights,
    count(*) FILTER (fdi_category IN ('HIGH', 'CRITICAL')) AS high_fdi_flights,
    {rnd("coalesce(avg(CAST(predicted_delay_minutes AS DOUBLE)), 0)")} AS avg_delay_minutes,
    {rnd(f"coalesce(avg(CAST(fdi AS DOUBLE)) FILTER ({DELAYED}), 0)")} AS avg_fdi,
    CAST(coalesce(sum(affected_passengers) FILTER ({DELAYED}), 0) AS BIGINT)
        AS total_affected_passengers,
    CAST(coalesce(sum(estimated_compensation_eur) FILTER ({DELAYED}), 0) AS BIGINT)
        AS total_estimated_compensation_eur
    FROM enriched"""

SERVED_DELAYED = "coalesce(delay_category, '') NOT IN ('ON TIME', '', 'UNKNOWN')"
IMPACT = f"""SELECT count(*) AS total_flights,
    count(*) FILTER (fdi_category IN ('HIGH', 'CRITICAL')) AS high_fdi_flights,
    count(*) FILTER (delay_category = 'CRITICAL DELAY') AS critical_delay_flights,
    count(*) FILTER (res_category IN ('HIGH', 'CRITICAL')) AS high_res_flights,
    CAST(coalesce(sum(affected_passengers) FILTER ({SERVED_DELAYED}), 0) AS BIGINT)
        AS total_affected_passengers,
    CAST(coalesce(sum(estimated_compensation_eur) FILTER ({SERVED_DELAYED}), 0) AS BIGINT)
        AS total_estimated_compensation_eur,
    {rnd(f"coalesce(avg(CAST(fdi AS DOUBLE)) FILTER ({SERVED_DELAYED}), 0)", 6)} AS avg_fdi,
    {rnd("coalesce(avg(res), 0)", 6)} AS avg_res
    FROM ripple"""

LIVE_RIPPLE = ", ".join(f"{c}" for c in S.LIVE_COLUMNS) + (
    ", next_flight_id, next_flight_gap_min, downstream_flight_count, res, res_category"
)
CRITICAL = "delay_category = 'CRITICAL DELAY'"
SIGHTED = {"sighted": _latest(f"(SELECT * FROM live_rows WHERE {CRITICAL})")}
NEWEST = "(SELECT max(timestamp) FROM live_rows)"
LABELLED = {
    "labelled": """SELECT *, given_delay AS delay_minutes, predicted_delay_minutes AS prediction,
        CAST(given_delay AS DOUBLE) - CAST(predicted_delay_minutes AS DOUBLE) AS err FROM ruled"""
}


def _quantile(value: str, p: str) -> str:
    """Smallest value whose rank reaches the share ``p`` of the rows."""
    return (
        f"(SELECT min(v) FROM (SELECT v, row_number() OVER (ORDER BY v) AS n, "
        f"count(*) OVER () AS total FROM (SELECT {value} AS v FROM labelled)) "
        f"WHERE n >= ceil({p} * total))"
    )


PARSE_TEXT = """CASE event_id % 8 WHEN 0 THEN CAST(k AS VARCHAR) WHEN 1 THEN k || '.75'
    WHEN 2 THEN '-' || k || '.5' WHEN 3 THEN 'n/a' WHEN 4 THEN '' WHEN 5 THEN NULL
    WHEN 6 THEN k || 'd' ELSE ' ' || k || 'e1 ' END"""

HEADING_STAGES = {
    "fixes": """
        SELECT flight_id, timestamp, latitude AS lat, longitude AS lon FROM reports
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY flight_id, timestamp
            ORDER BY ingested_at DESC, latitude DESC, longitude DESC) = 1""",
    "moves": """
        SELECT *, lat - lag(lat) OVER w AS north, lon - lag(lon) OVER w AS east FROM fixes
        WINDOW w AS (PARTITION BY flight_id ORDER BY timestamp)""",
    "turned": """
        SELECT *, CASE WHEN abs(north) > 1e-4 OR abs(east) > 1e-4
            THEN degrees(atan2(east, north)) END AS move FROM moves""",
}


def statements() -> dict[str, str]:
    featured = {
        "base_features": f"{ROW}, is_raining, is_high_wind, is_low_visibility, is_bad_weather, "
        "flight_phase, is_slow, speed_altitude_ratio, is_peak_hour, is_weekend",
        "weather_score": f"{ROW}, weather_score",
        "distance_route": f"{ROW}, distance_km, route_deviation",
        "time_features": f"{ROW}, hour_utc, is_peak_hour, day_of_week, is_weekend, "
        "traffic_density",
        "risk_score": f"{ROW}, risk_score_manual",
        "weather_condition": f"""{ROW}, CASE WHEN weather_code <= 1 THEN 'CLEAR'
            WHEN weather_code <= 3 THEN 'PARTLY CLOUDY'
            WHEN weather_code BETWEEN 51 AND 69 THEN 'RAIN'
            WHEN weather_code BETWEEN 71 AND 79 THEN 'SNOW'
            WHEN weather_code BETWEEN 80 AND 99 THEN 'STORM' ELSE 'CLOUDY' END
            AS weather_condition""",
    }
    out = {name: upto("featured", f"SELECT {cols} FROM featured") for name, cols in featured.items()}

    # sources and lake layers
    all_columns = ", ".join(
        f"CASE WHEN {SENT} THEN {c} END AS {c}" for c in S.BRONZE_COLUMNS
    )
    out["src_events_parse"] = upto(
        "reports", f"SELECT timestamp AS kafka_epoch_s, {all_columns} FROM reports"
    )
    out["clean_flights"] = upto("clean", f"SELECT {BRONZE} FROM clean")
    out["bronze_projection"] = upto(
        "reports",
        f"SELECT {BRONZE}, DATE '1970-01-01' + CAST(timestamp // 86400 AS INTEGER) "
        "AS ingestion_date FROM reports",
    )
    out["silver_projection"] = upto("ruled", f"SELECT {SILVER} FROM ruled")
    out["feed_normalize"] = upto("ev", FEED)
    out["kafka_payload_decoded"] = upto(
        "enriched",
        f"SELECT flight_id AS key, {', '.join(S.PAYLOAD_COLUMNS)} FROM enriched",
    )
    out["event_emission_decoded"] = upto(
        "ev",
        _asof("feed", "flight_id AS key, " + ", ".join(f"r.{c}" for c in S.REPORT_COLUMNS)),
        {"feed": FEED, **WEATHER_STAGES},
    )
    out["weather_asof_join"] = upto(
        "reports", _asof("reports", "flight_id, ingested_at, timestamp"), WEATHER_STAGES
    )

    # features and impact
    out["rule_delay"] = upto(
        "ruled", f"SELECT {ROW}, predicted_delay_minutes, delay_category FROM ruled"
    )
    out["safe_parse"] = upto(
        "ev",
        f"""SELECT event_id, coalesce(TRY_CAST(t AS DOUBLE), 0) AS as_double,
            coalesce(CAST(trunc(TRY_CAST(t AS DOUBLE)) AS INTEGER), 0) AS as_int
            FROM (SELECT event_id, {PARSE_TEXT} AS t FROM ev)""",
    )
    for name in ("capacity_lookup", "capacity_join"):
        out[name] = upto(
            "enriched", f"SELECT {ROW}, aircraft_model, capacity, affected_passengers FROM enriched"
        )
    out["flight_delay_index"] = upto(
        "enriched", f"SELECT {ROW}, normalized_delay, fdi, fdi_category FROM enriched"
    )
    out["compensation"] = upto(
        "enriched",
        f"SELECT {ROW}, affected_passengers, estimated_compensation_eur FROM enriched",
    )

    # dimension joins
    out["airline_name_join"] = upto(
        "clean",
        f"""SELECT flight_id, ingested_at, c.airline_icao,
            coalesce(n.airline_name, '{K.UNKNOWN_AIRLINE}') AS airline_name
            FROM clean c LEFT JOIN (VALUES {_rows(K.AIRLINE_NAMES.items())})
            n(airline_icao, airline_name) USING (airline_icao)""",
    )
    ends = ", ".join(
        f"{a}.{c} AS {end}_{c}"
        for end, a in (("origin", "o"), ("destination", "d"))
        for c in ("icao", "name", "country", "lat", "lon")
    )
    out["route_airport_join"] = upto(
        "clean",
        f"""SELECT flight_id, ingested_at, origin, destination, {ends} FROM clean
            LEFT JOIN airports o ON o.iata = origin
            LEFT JOIN airports d ON d.iata = destination""",
        {
            "airports": f"""SELECT iata, icao, name, country, CAST(lat AS DOUBLE) AS lat,
                CAST(lon AS DOUBLE) AS lon
                FROM (VALUES {_rows(K.AIRPORTS)}) a(iata, icao, name, country, lat, lon)"""
        },
    )

    # gold
    for name, select in GOLD.items():
        out[f"gold_{name}"] = upto("enriched", select)
    out["gold_date_range"] = upto(
        "enriched",
        gold_airline("WHERE report_date >= DATE '2024-01-10' AND report_date < DATE '2024-01-15'"),
    )
    out["gold_refresh_range"] = upto(
        "enriched",
        gold_airline(
            "WHERE report_date <> DATE '2024-01-11' "
            "AND NOT (report_date = DATE '2024-01-12' AND airline_icao = 'GIA')"
        ),
    )
    out["gold_incremental"] = upto("enriched", GOLD["airline_daily_performance"])
    out["gold_incremental_routes"] = upto("enriched", GOLD["route_daily_statistics"])
    out["gold_by_name"] = upto("enriched", GOLD["hourly_delay_trends"])
    odd = """CASE timestamp % 4 WHEN 1 THEN timestamp * 1000 WHEN 2 THEN timestamp * 1000000
        WHEN 3 THEN -timestamp ELSE timestamp END"""
    out["bronze_odd_times"] = upto(
        "reports",
        f"""SELECT flight_id, ingested_at, {odd} AS timestamp,
            CASE WHEN timestamp % 4 = 0 THEN DATE '1970-01-01' + CAST(timestamp // 86400 AS INTEGER)
            END AS ingestion_date FROM reports""",
    )
    out["gold_json_decoded"] = upto("enriched", GOLD["route_daily_statistics"])
    out["gold_summary"] = upto(
        "enriched",
        " UNION ALL ".join(
            f"SELECT '{name}' AS \"table\", count(*) AS rows FROM ({select})"
            for name, select in GOLD.items()
        ),
    )

    # live view, rotations, ripple
    out["live_state"] = upto("live", f"SELECT {LIVE} FROM live")
    out["live_active"] = upto(
        "live_rows",
        f"SELECT {LIVE} FROM current",
        {
            "current": _latest(
                f"(SELECT * FROM live_rows WHERE timestamp > {NEWEST} - {K.LIVE_TTL_S})"
            )
        },
    )
    rotation = """SELECT registration, flight_id, max(timestamp) AS timestamp FROM enriched
        WHERE registration <> '' AND timestamp <> 0 {0} GROUP BY registration, flight_id"""
    out["rotation_index"] = upto("enriched", rotation.format(""))
    out["rotation_recent"] = upto(
        "enriched",
        rotation.format(
            f"AND timestamp > (SELECT max(timestamp) FROM enriched) - {K.ROTATION_HORIZON_S}"
        ),
    )
    out["downstream_count"] = upto(
        "onward", "SELECT flight_id, registration, timestamp, downstream_flight_count FROM onward"
    )
    out["next_flight"] = upto(
        "onward",
        "SELECT flight_id, registration, timestamp, next_flight_id, next_flight_gap_min "
        "FROM onward",
    )
    out["rotation_self_join"] = upto(
        "onward",
        """SELECT a.flight_id, a.registration, a.timestamp, a.next_flight_id, a.next_timestamp,
            a.downstream_flight_count AS downstream_count,
            b.destination AS next_destination, b.delay_category AS next_delay_category,
            b.timestamp AS next_last_seen
            FROM onward a JOIN live b ON b.flight_id = a.next_flight_id""",
    )
    out["track_heading"] = upto(
        "reports",
        f"""SELECT flight_id, timestamp, lat, lon, {rnd("last_value(move IGNORE NULLS) OVER w", 6)}
            AS heading FROM turned WINDOW w AS (PARTITION BY flight_id ORDER BY timestamp
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        HEADING_STAGES,
    )
    out["ripple_effect"] = upto("ripple", f"SELECT {', '.join(RIPPLE_COLUMNS)} FROM ripple")
    out["flight_impact"] = upto("ripple", f"SELECT {', '.join(IMPACT_COLUMNS)} FROM ripple")

    ripple_columns, one = ", ".join(RIPPLE_COLUMNS), "flight_id = 'F0-78929'"
    out["ripple_active"] = upto(
        "ripple", f"SELECT {ripple_columns} FROM ripple WHERE timestamp > {NEWEST} - {K.LIVE_TTL_S}"
    )
    out["ripple_effect_one"] = upto("ripple", f"SELECT {ripple_columns} FROM ripple WHERE {one}")
    out["flight_impact_one"] = upto(
        "ripple", f"SELECT {', '.join(IMPACT_COLUMNS)} FROM ripple WHERE {one}"
    )

    # aggregates
    out["batch_stats"] = upto("enriched", BATCH_STATS)
    out["aggregate_impact"] = upto("ripple", IMPACT)
    out["airline_performance"] = upto("performance", "SELECT * FROM performance")
    out["dashboard_totals"] = upto(
        "live",
        f"SELECT count(*) AS total_flights, count(*) FILTER ({CRITICAL}) AS total_alerts FROM live",
    )
    out["dashboard_impact"] = upto("ripple", IMPACT)
    out["dashboard_airlines"] = upto("performance", "SELECT * FROM performance")
    out["dashboard_live_totals"] = out["dashboard_totals"]
    out["delay_category_distribution"] = upto(
        "ruled",
        f"""SELECT {category("delay_minutes")} AS delay_category, count(*) AS count
            FROM labelled GROUP BY 1""",
        LABELLED,
    )
    label = "CAST(delay_minutes AS DOUBLE)"
    out["label_summary"] = upto(
        "ruled",
        f"""SELECT {rnd(f"avg({label})", 2)} AS mean, {rnd(f"stddev_samp({label})", 2)} AS stddev,
            {rnd(f"min({label})", 2)} AS min, {rnd(f"max({label})", 2)} AS max,
            {rnd(_quantile(label, "0.5"), 2)} AS median FROM labelled""",
        LABELLED,
    )
    out["error_distribution"] = upto(
        "ruled",
        f"""SELECT {rnd("avg(abs(err))", 2)} AS mean_abs_error,
            {rnd(_quantile("abs(err)", "0.5"), 2)} AS median_abs_error,
            {rnd(_quantile("abs(err)", "0.9"), 2)} AS p90_abs_error FROM labelled""",
        LABELLED,
    )
    out["regression_metrics"] = upto(
        "ruled",
        f"""SELECT {rnd("sqrt(avg(err * err))", 4)} AS rmse, {rnd("avg(abs(err))", 4)} AS mae,
            {rnd(f"1 - sum(err * err) / (var_pop({label}) * count(*))", 4)} AS r2
            FROM labelled""",
        LABELLED,
    )

    # served lists
    out["list_flights"] = upto(
        "ripple",
        f"SELECT {LIVE_RIPPLE} FROM ripple WHERE airline = 'LNI' AND {CRITICAL} "
        "AND fdi_category = 'HIGH'",
    )
    out["list_flights_limited"] = upto(
        "ripple",
        f"SELECT {LIVE_RIPPLE} FROM ripple WHERE res_category = 'MODERATE' "
        "ORDER BY flight_id LIMIT 100",
    )
    out["flight_detail"] = upto("live", f"SELECT {LIVE} FROM live WHERE flight_id = 'F0-78929'")
    out["flight_lookup"] = out["flight_detail"]
    out["aircraft_lookup"] = upto("live", f"SELECT {LIVE} FROM live WHERE registration = 'PK-00042'")
    out["list_airlines"] = upto(
        "performance",
        "SELECT * FROM performance WHERE api_score >= 70 AND api_category = 'GOOD' "
        "ORDER BY api_score DESC, airline_icao LIMIT 500",
    )
    out["airline_detail"] = upto("performance", "SELECT * FROM performance WHERE airline_icao = 'GIA'")
    out["airline_ranking"] = upto(
        "performance",
        "SELECT CAST(row_number() OVER (ORDER BY api_score DESC, airline_icao) AS INTEGER) "
        "AS rank, * FROM performance",
    )
    out["top_airlines"] = upto(
        "performance",
        "SELECT * FROM performance ORDER BY api_score DESC, airline_icao LIMIT 10",
    )
    out["critical_alerts"] = upto(
        "live_rows", f"SELECT {LIVE}, timestamp AS alert_created_at FROM sighted", SIGHTED
    )
    out["active_alerts"] = upto(
        "live_rows",
        f"""SELECT {LIVE}, timestamp AS alert_created_at,
            CAST(greatest(0, timestamp + {K.ALERT_TTL_S} - {NEWEST}) AS INTEGER) AS ttl_seconds
            FROM sighted WHERE timestamp > {NEWEST} - {K.ALERT_TTL_S}""",
        SIGHTED,
    )
    out["alert_scan"] = upto(
        "ripple",
        f"SELECT {LIVE_RIPPLE}, timestamp AS alert_created_at FROM ripple WHERE {CRITICAL}",
    )
    out["top_alerts"] = upto(
        "ripple",
        f"SELECT {LIVE_RIPPLE} FROM ripple WHERE {CRITICAL} "
        "ORDER BY coalesce(fdi, 0) DESC, flight_id LIMIT 10",
    )
    out["alert_severity"] = upto(
        "ripple",
        f"""SELECT flight_id, fdi, res, res_category,
            CASE WHEN fdi >= 30 THEN 'RED' WHEN fdi >= 15 THEN 'AMBER' ELSE 'NONE' END
                AS fdi_severity,
            CASE WHEN res_category IN ('HIGH', 'CRITICAL') THEN 'SPREADS'
                 WHEN res_category = 'MODERATE' THEN 'MAY SPREAD' ELSE 'SAFE' END AS ripple_advice
            FROM ripple WHERE {CRITICAL}""",
    )
    out["kpi_header"] = upto(
        "ripple",
        """SELECT coalesce(nullif(i.critical_delay_flights, 0), nullif(s.critical_flights, 0), 0)
                AS critical_delay_flights,
            coalesce(nullif(i.total_estimated_compensation_eur, 0),
                nullif(s.total_estimated_compensation_eur, 0), 0)
                AS total_estimated_compensation_eur,
            coalesce(nullif(i.total_affected_passengers, 0),
                nullif(s.total_affected_passengers, 0), 0) AS total_affected_passengers,
            coalesce(nullif(i.avg_fdi, 0), nullif(s.avg_fdi, 0), 0) AS avg_fdi
            FROM impact i, stats s""",
        {"impact": IMPACT, "stats": BATCH_STATS},
    )

    # streams: the same rows as the batch path, less the messages that are not JSON
    out["stream_silver"] = upto("ruled", f"SELECT {SILVER} FROM ruled WHERE {SENT}")
    out["silver_compacted"] = out["stream_silver"]
    out["stream_fanout"] = upto(
        "ruled",
        f"""SELECT (SELECT count(*) FROM reports) AS bronze_rows,
            (SELECT count(*) FROM ruled WHERE {SENT}) AS silver_rows,
            (SELECT count(*) FROM ruled WHERE {SENT}) AS prediction_rows""",
    )
    # An hour has closed when the newest report, less ten minutes, lies beyond it.
    out["stream_latest"] = upto(
        "reports",
        f"""SELECT {BRONZE} FROM reports WHERE {SENT} AND timestamp // 3600 * 3600 + 3600
                <= (SELECT max(timestamp) - 600 FROM reports WHERE {SENT})
            QUALIFY row_number() OVER (PARTITION BY flight_id, timestamp // 3600
                ORDER BY timestamp DESC, ingested_at DESC) = 1""",
    )
    out["stream_live_state"] = upto(
        "ruled",
        f"SELECT {LIVE} FROM streamed",
        {
            "sent_rows": f"SELECT {_LIVE_SELECT} FROM ruled WHERE {SENT}",
            "streamed": _latest("sent_rows"),
        },
    )
    numbers = " UNION ALL ".join(
        f"""SELECT '{c}' AS category, {c} AS value,
            CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER) AS number
            FROM labelled WHERE {c} <> '' GROUP BY {c}"""
        for c in training.CATEGORIES
    )
    labelled = {"labelled": "SELECT * FROM featured"}
    out["ml_string_index"] = upto("featured", numbers, labelled)
    out["ml_scaler"] = upto(
        "featured",
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
            round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS deviation FROM labelled"""
            for c in training.NUMERIC
        ),
        labelled,
    )
    out["ml_cluster_nearest"] = upto("featured", "SELECT count(*) AS rows, count(*) AS nearest FROM featured")
    out["ml_forest_walk"] = upto("featured", "SELECT count(*) AS rows, count(*) AS equal FROM featured")
    out["ml_split"] = upto(
        "featured",
        """SELECT flight_id, ingested_at, CAST('0x' || substr(md5(concat_ws('|', flight_id, ingested_at)),
            1, 8) AS BIGINT) % 100 < 80 AS teaches FROM featured""",
    )
    out["ml_null_skip"] = upto(
        "featured", f"SELECT {ROW} FROM featured WHERE altitude_ft % 7 <> 0"
    )
    first, second = training.CATEGORIES
    # A category has a place for each known value and one for all others.
    out["ml_one_hot"] = upto(
        "featured",
        f"""SELECT category, value, CAST({len(training.NUMERIC)} + number
            + CASE category WHEN '{second}'
                THEN (SELECT count(DISTINCT {first}) + 1 FROM labelled WHERE {first} <> '') ELSE 0 END
            AS INTEGER) AS place FROM ({numbers})""",
        labelled,
    )
    out["stream_alerts"] = upto(
        "ruled",
        "SELECT flight_id, timestamp, predicted_delay_minutes FROM streamed",
        {
            "sent_rows": f"SELECT {_LIVE_SELECT} FROM ruled WHERE {SENT}",
            "streamed": _latest(f"(SELECT * FROM sent_rows WHERE {CRITICAL} AND flight_id <> '')"),
        },
    )
    out["stream_rotations"] = upto(
        "ruled",
        f"""SELECT registration, flight_id, max(timestamp) AS timestamp FROM ruled
        WHERE registration <> '' AND timestamp <> 0 AND {SENT} GROUP BY registration, flight_id""",
    )
    return out
