"""The same queries as DuckDB SQL over the given tables."""

from __future__ import annotations

_MS = "epoch_us(ts) // 1000"

_VIEWS = {
    "rides": f"""
        SELECT event_id, CAST(user_id AS INT) AS driver_id,
               CAST((event_id * 7 + user_id) % 29 AS INT) AS PULocationID,
               CAST((event_id * 11 + user_id * 3) % 29 AS INT) AS DOLocationID,
               ROUND(0.5 + (event_id % 245) / CAST(10 AS DOUBLE), 2) AS trip_distance,
               value AS total_amount, {_MS} AS tpep_pickup_datetime,
               make_timestamp({_MS} * 1000) AS event_time, event_type
        FROM events""",
    "taxi_zones": """
        SELECT n_nationkey AS zone_id, r_name AS borough, n_name AS zone_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "zone_versions": """
        SELECT zone_id, zone_name || ' v' || version AS zone_name, version,
               TIMESTAMP '2024-01-02' + to_days(CAST(version * 14 AS INT))
                 + to_hours(zone_id) AS valid_from
        FROM taxi_zones CROSS JOIN (VALUES (0), (1), (2)) AS t(version)""",
    "all_drivers": """
        SELECT CAST(c_custkey AS INT) AS driver_id, c_name AS name,
               ROUND(4.5 + (c_custkey % 50) / CAST(100 AS DOUBLE), 2) AS rating, c_mktsegment
        FROM customer""",
    "drivers": """
        SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN -driver_id ELSE driver_id END AS driver_id,
               name, rating
        FROM all_drivers""",
    "driver_updates": """
        SELECT CAST(o_custkey AS INT) AS driver_id,
               'Driver ' || o_custkey || ' ' || o_orderstatus AS name,
               ROUND(4.5 + (o_orderkey % 50) / CAST(100 AS DOUBLE), 2) AS rating,
               TIMESTAMP '2024-01-01' + to_minutes(o_orderkey * 37 % 43200) AS updated_at,
               o_orderkey AS update_id
        FROM orders""",
    "pickups": """
        SELECT CAST(event_id AS VARCHAR) AS trip_id, PULocationID AS pickup_zone,
               event_time AS pickup_time
        FROM rides""",
    "dropoffs": """
        SELECT CASE WHEN event_type = 'error' THEN 'lost ' ELSE '' END || event_id AS trip_id,
               DOLocationID AS dropoff_zone,
               event_time + to_minutes(event_id % 150) AS dropoff_time, total_amount AS fare
        FROM rides""",
    "day_trips": """
        SELECT p.trip_id, pickup_zone, dropoff_zone, pickup_time, dropoff_time,
               date_sub('minute', pickup_time, dropoff_time) AS duration_minutes, fare
        FROM pickups p JOIN dropoffs d ON p.trip_id = d.trip_id
          AND dropoff_time BETWEEN pickup_time AND pickup_time + INTERVAL 1 DAY""",
    "late_rides": """
        SELECT *, event_time + to_minutes(
                 CASE WHEN event_id % 10 < 3 THEN 5 + event_id % 26 ELSE 0 END) AS arrival_time
        FROM rides""",
    "observed": """
        SELECT event_id, PULocationID AS zone_id, total_amount AS fare, event_time, watermark,
               arrival_time AS proc_time,
               CASE WHEN event_time < watermark THEN 'LATE' ELSE 'on-time' END AS status
        FROM (SELECT *, MAX(event_time) OVER (ORDER BY arrival_time, event_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 5 SECOND AS watermark
              FROM late_rides)""",
    "hours": """
        SELECT PULocationID AS zone_id, time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
               time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR AS window_end,
               COUNT(*) AS trip_count, ROUND(SUM(total_amount), 2) AS total_revenue
        FROM rides GROUP BY 1, 2, 3""",
    "sliding": """
        SELECT zone_id, window_start, window_start + INTERVAL 1 HOUR AS window_end,
               COUNT(*) AS trip_count, {avg_fare} AS avg_fare
        FROM (SELECT PULocationID AS zone_id, total_amount,
                     time_bucket(INTERVAL 10 MINUTE, event_time)
                       - to_minutes(CAST(o * 10 AS INT)) AS window_start
              FROM rides CROSS JOIN generate_series(0, 5) AS g(o))
        GROUP BY zone_id, window_start""",
    "sessions": """
        SELECT driver_id, MIN(event_time) AS session_start,
               MAX(event_time) + INTERVAL 6 HOUR AS session_end,
               COUNT(*) AS trip_count, ROUND(SUM(total_amount), 2) AS total_revenue
        FROM (SELECT *, SUM(opens) OVER (PARTITION BY driver_id ORDER BY event_time, event_id
                       ROWS UNBOUNDED PRECEDING) AS nth
              FROM (SELECT *, CASE WHEN event_time - LAG(event_time) OVER (PARTITION BY driver_id
                             ORDER BY event_time, event_id) <= INTERVAL 6 HOUR
                           THEN 0 ELSE 1 END AS opens
                    FROM rides))
        GROUP BY driver_id, nth""",
    "alerts": """
        SELECT PULocationID AS zone_id, time_bucket(INTERVAL 1 DAY, event_time) AS window_start,
               time_bucket(INTERVAL 1 DAY, event_time) + INTERVAL 1 DAY AS window_end,
               COUNT(*) AS ride_count
        FROM rides GROUP BY 1, 2, 3 HAVING COUNT(*) > 20""",
    "totals": """
        SELECT PULocationID AS zone_id, COUNT(*) AS total_trips,
               ROUND(SUM(total_amount), 2) AS total_revenue, MAX(event_time) AS last_updated
        FROM rides GROUP BY 1""",
    "answered": """
        SELECT r.event_id, r.driver_id, r.event_time, r.total_amount,
               n.name AS now_name, n.rating AS now_rating,
               f.name AS first_name, f.rating AS first_rating, f.updated_at AS first_at
        FROM rides r
        ASOF LEFT JOIN (SELECT * FROM driver_updates QUALIFY ROW_NUMBER() OVER (
                          PARTITION BY driver_id, updated_at ORDER BY update_id DESC) = 1) n
          ON r.driver_id = n.driver_id AND r.event_time >= n.updated_at
        LEFT JOIN (SELECT * FROM driver_updates QUALIFY ROW_NUMBER() OVER (
                     PARTITION BY driver_id ORDER BY updated_at, update_id) = 1) f
          ON r.driver_id = f.driver_id""",
}

_NEEDS = {
    "zone_versions": ["taxi_zones"],
    "drivers": ["all_drivers"],
    "pickups": ["rides"],
    "dropoffs": ["rides"],
    "day_trips": ["pickups", "dropoffs"],
    "late_rides": ["rides"],
    "observed": ["late_rides"],
    "hours": ["rides"],
    "sliding": ["rides"],
    "sessions": ["rides"],
    "alerts": ["rides"],
    "totals": ["rides"],
    "answered": ["rides", "driver_updates"],
}


def _average(value: str) -> str:
    return f"CAST(CAST(CAST({value} AS DECIMAL(38,10)) AS DECIMAL(28,6)) AS DOUBLE)"


def _sql(views: list[str], body: str) -> str:
    ordered: list[str] = []

    def need(view: str) -> None:
        for other in _NEEDS.get(view, []):
            need(other)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        need(view)
    if not ordered:
        return body
    avg_fare = _average("AVG(total_amount)")
    parts = (f"{v} AS ({_VIEWS[v].replace('{avg_fare}', avg_fare)})" for v in ordered)
    return "WITH " + ",\n".join(parts) + "\n" + body


_R = ["rides"]
_RIDE = "PULocationID, DOLocationID, trip_distance, total_amount"

_TRIPS = """
    SELECT p.trip_id, pickup_zone, dropoff_zone, pickup_time, dropoff_time,
           date_sub('minute', pickup_time, dropoff_time) AS duration_minutes, fare
    FROM pickups p {how} JOIN dropoffs d ON p.trip_id = d.trip_id
      AND dropoff_time BETWEEN pickup_time AND pickup_time + INTERVAL 30 MINUTE"""

_LATENESS = """
    SELECT zone_id, window_start, window_end, COUNT(*) AS trip_count,
           ROUND(SUM(fare), 2) AS total_revenue,
           COUNT(*) FILTER (WHERE window_end <= watermark) AS late_updates
    FROM (SELECT *, time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
                 time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end
          FROM observed)
    WHERE watermark IS NULL OR window_end + INTERVAL {minutes} MINUTE > watermark
    GROUP BY 1, 2, 3"""


def oracle_sql() -> dict[str, str]:
    avg_fare, avg_distance = _average("AVG(total_amount)"), _average("AVG(trip_distance)")
    avg_duration = _average("AVG(duration_minutes)")
    running = _average(
        "AVG(total_amount) OVER (PARTITION BY PULocationID ORDER BY event_time, event_id "
        "ROWS UNBOUNDED PRECEDING)"
    )
    return {
        "filter_high_fare": _sql(_R, f"SELECT {_RIDE} FROM rides WHERE total_amount > 20"),
        "filter_premium": _sql(
            _R, f"SELECT {_RIDE} FROM rides WHERE total_amount > 50 AND trip_distance > 5"
        ),
        "map_to_eur": _sql(_R, """
            SELECT PULocationID AS pickup_zone, DOLocationID AS dropoff_zone,
                   trip_distance AS distance_miles,
                   total_amount * CAST(0.92 AS DOUBLE) AS fare_eur FROM rides"""),
        "price_per_mile": _sql(_R, """
            SELECT PULocationID AS pickup_zone, DOLocationID AS dropoff_zone,
                   trip_distance AS distance_miles,
                   total_amount * CAST(0.92 AS DOUBLE) AS fare_eur,
                   total_amount * CAST(0.92 AS DOUBLE) / NULLIF(trip_distance, 0)
                     AS price_per_mile FROM rides"""),
        "flatmap_zone_events": _sql(_R, """
            SELECT 'pickup' AS event_type, PULocationID AS zone_id,
                   tpep_pickup_datetime AS event_timestamp FROM rides
            UNION ALL SELECT 'dropoff', DOLocationID, tpep_pickup_datetime FROM rides"""),
        "flatmap_ride_complete": _sql(_R, """
            SELECT 'pickup' AS event_type, PULocationID AS zone_id,
                   tpep_pickup_datetime AS event_timestamp, CAST(NULL AS DOUBLE) AS total_amount
            FROM rides
            UNION ALL SELECT 'dropoff', DOLocationID, tpep_pickup_datetime, NULL FROM rides
            UNION ALL SELECT 'ride_complete', DOLocationID, tpep_pickup_datetime, total_amount
            FROM rides"""),
        "pass_through_json": _sql(_R, """
            SELECT event_id, driver_id, PULocationID, DOLocationID, trip_distance,
                   total_amount * 2 AS total_amount, tpep_pickup_datetime, 'rides' AS source
            FROM rides"""),
        "constant_column": _sql(
            _R, "SELECT event_id, total_amount, 'USD' AS currency FROM rides"
        ),
        "default_driver_key": _sql(
            _R, "SELECT event_id, COALESCE(NULLIF(driver_id, 7), 0) AS driver_id FROM rides"
        ),
        "union_all_zones": _sql(_R, """
            SELECT PULocationID AS zone_id, event_id FROM rides
            UNION ALL SELECT DOLocationID, event_id FROM rides"""),
        "union_distinct_zones": _sql(_R, """
            SELECT PULocationID AS zone_id, driver_id FROM rides
            UNION SELECT DOLocationID, driver_id FROM rides"""),
        "tumbling_revenue": _sql(["hours"], "SELECT * FROM hours"),
        "tumbling_minute_revenue": _sql(_R, """
            SELECT PULocationID AS zone_id,
                   time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start,
                   time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE AS window_end,
                   COUNT(*) AS trip_count, ROUND(SUM(total_amount), 2) AS total_revenue
            FROM rides GROUP BY 1, 2, 3"""),
        "hourly_revenue": _sql(["hours"], """
            SELECT zone_id, window_end, trip_count, total_revenue AS revenue FROM hours"""),
        "windowed_revenue": _sql(["hours"], """
            SELECT zone_id, window_end, total_revenue AS revenue FROM hours"""),
        "hourly_counts": _sql(["hours"], """
            SELECT zone_id, window_start, window_end, trip_count FROM hours"""),
        "sliding_average": _sql(["sliding"], "SELECT * FROM sliding"),
        "session_driver": _sql(["sessions"], "SELECT * FROM sessions"),
        "sliding_average_default": _sql(["rides"], f"""
            SELECT zone_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
                   COUNT(*) AS trip_count, {_average("AVG(total_amount)")} AS avg_fare
            FROM (SELECT PULocationID AS zone_id, total_amount,
                         time_bucket(INTERVAL 10 SECOND, event_time)
                           - to_seconds(o * 10) AS window_start
                  FROM rides CROSS JOIN generate_series(0, 29) AS g(o))
            GROUP BY zone_id, window_start"""),
        "session_driver_default": _sql(["rides"], """
            SELECT driver_id, MIN(event_time) AS session_start,
                   MAX(event_time) + INTERVAL 10 SECOND AS session_end,
                   COUNT(*) AS trip_count, ROUND(SUM(total_amount), 2) AS total_revenue
            FROM (SELECT *, SUM(opens) OVER (PARTITION BY driver_id ORDER BY event_time, event_id
                           ROWS UNBOUNDED PRECEDING) AS nth
                  FROM (SELECT *, CASE WHEN event_time - LAG(event_time) OVER (
                                 PARTITION BY driver_id ORDER BY event_time, event_id)
                                 <= INTERVAL 10 SECOND THEN 0 ELSE 1 END AS opens
                        FROM rides))
            GROUP BY driver_id, nth"""),
        "rate_alerts_default": _sql(["rides"], """
            SELECT PULocationID AS zone_id, w AS window_start, w + INTERVAL 1 MINUTE AS window_end,
                   COUNT(*) AS ride_count
            FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE,
                              make_timestamp(epoch_us(event_time) // 1440)) AS w FROM rides)
            GROUP BY 1, 2, 3 HAVING COUNT(*) > 20"""),
        "window_kind_counts": _sql(["hours", "sliding", "sessions"], """
            SELECT 'tumbling' AS type, COUNT(*) AS rows FROM hours
            UNION ALL SELECT 'sliding', COUNT(*) FROM sliding
            UNION ALL SELECT 'session', COUNT(*) FROM sessions"""),
        "rate_alerts": _sql(["alerts"], "SELECT * FROM alerts"),
        "cumulative_counter": _sql(["totals"], "SELECT * FROM totals"),
        "zone_cumulative": _sql(["totals"], "SELECT zone_id, total_trips FROM totals"),
        "max_fare_tracker": _sql(_R, """
            SELECT PULocationID AS zone_id, MAX(total_amount) AS max_fare,
                   MAX(trip_distance) AS max_distance FROM rides GROUP BY 1"""),
        "min_fare_tracker": _sql(_R, """
            SELECT PULocationID AS zone_id, MIN(total_amount) AS min_fare
            FROM rides GROUP BY 1"""),
        "avg_stats": _sql(_R, f"""
            SELECT PULocationID AS zone_id, {avg_fare} AS avg_fare,
                   {avg_distance} AS avg_distance, COUNT(*) AS trip_count
            FROM rides GROUP BY 1"""),
        "processing_stats": _sql(_R, """
            SELECT 'total_events' AS stat_name, COUNT(*) AS stat_value,
                   MAX(event_time) AS last_updated FROM rides"""),
        "row_count": "SELECT COUNT(*) AS row_count FROM events",
        "zone_entries_exits": _sql(_R, """
            SELECT zone_id, event_type, COUNT(*) AS event_count
            FROM (SELECT PULocationID AS zone_id, 'pickup' AS event_type FROM rides
                  UNION ALL SELECT DOLocationID, 'dropoff' FROM rides)
            GROUP BY 1, 2"""),
        "dedup": _sql(_R, """
            SELECT driver_id, PULocationID, DOLocationID, event_time, event_id, total_amount
            FROM rides QUALIFY ROW_NUMBER() OVER (
              PARTITION BY driver_id, PULocationID, DOLocationID
              ORDER BY event_time, event_id) = 1"""),
        "last_n": _sql(_R, """
            SELECT PULocationID AS zone_id, ROW_NUMBER() OVER (PARTITION BY PULocationID
                     ORDER BY event_time DESC, event_id DESC) AS recency,
                   event_id, event_time, total_amount AS fare
            FROM rides QUALIFY recency <= 5"""),
        "running_avg": _sql(_R, f"""
            SELECT event_id, PULocationID AS zone_id, event_time, total_amount AS fare,
                   {running} AS running_avg FROM rides"""),
        "first_seen": _sql(_R, """
            SELECT driver_id, MIN(event_time) AS first_seen FROM rides GROUP BY 1"""),
        "change_detection": _sql(_R, """
            SELECT driver_id, event_time, event_id, previous_value,
                   PULocationID AS current_value
            FROM (SELECT *, LAG(PULocationID) OVER w AS previous_value,
                         ROW_NUMBER() OVER w AS nth
                  FROM rides
                  WINDOW w AS (PARTITION BY driver_id ORDER BY event_time, event_id))
            WHERE nth > 1 AND previous_value IS DISTINCT FROM PULocationID"""),
        "rate_verdict_per_event": _sql(_R, """
            SELECT event_id, zone_id, event_time, window_start, nth_in_window,
                   CASE WHEN nth_in_window <= 15 THEN 'allow' ELSE 'throttle' END AS verdict
            FROM (SELECT event_id, PULocationID AS zone_id, event_time,
                         time_bucket(INTERVAL 1 DAY, event_time) AS window_start,
                         COUNT(*) OVER (PARTITION BY PULocationID,
                             time_bucket(INTERVAL 1 DAY, event_time)
                           ORDER BY event_time, event_id
                           ROWS UNBOUNDED PRECEDING) AS nth_in_window
                  FROM rides)"""),
        "top_zones": _sql(["totals"], """
            SELECT zone_id, total_trips, total_revenue FROM totals
            ORDER BY total_trips DESC, zone_id LIMIT 5"""),
        "top_fares": _sql(_R, """
            SELECT PULocationID AS zone_id, MAX(total_amount) AS max_fare,
                   MAX(trip_distance) AS max_distance FROM rides GROUP BY 1
            ORDER BY max_fare DESC, zone_id LIMIT 5"""),
        "latest_alerts": _sql(["alerts"], """
            SELECT * FROM alerts ORDER BY window_end DESC, zone_id LIMIT 10"""),
        "zone_slice": _sql(["hours"], """
            SELECT * FROM hours WHERE zone_id = 16 ORDER BY window_start LIMIT 5"""),
        "zone_lookup": _sql(["rides", "taxi_zones"], """
            SELECT PULocationID AS pickup_zone_id,
                   COALESCE(pz.zone_name, 'Unknown') AS pickup_zone_name,
                   DOLocationID AS dropoff_zone_id,
                   COALESCE(dz.zone_name, 'Unknown') AS dropoff_zone_name,
                   total_amount AS fare, event_time
            FROM rides LEFT JOIN taxi_zones pz ON PULocationID = pz.zone_id
            LEFT JOIN taxi_zones dz ON DOLocationID = dz.zone_id"""),
        "zone_asof": _sql(["rides", "zone_versions"], """
            SELECT event_id, PULocationID AS zone_id, event_time,
                   COALESCE(zone_name, 'Unknown') AS zone_name
            FROM rides ASOF LEFT JOIN zone_versions v
              ON PULocationID = v.zone_id AND event_time >= v.valid_from"""),
        "trip_join": _sql(["pickups", "dropoffs"], _TRIPS.format(how="")),
        "trip_outer": _sql(["pickups", "dropoffs"], _TRIPS.format(how="LEFT")),
        "trip_outcomes": _sql(["pickups", "dropoffs"], """
            SELECT CASE WHEN in_time THEN 'matched' WHEN in_time IS NULL THEN 'unmatched'
                        ELSE 'expired' END AS outcome, COUNT(*) AS trips
            FROM (SELECT p.trip_id, MAX(dropoff_time BETWEEN pickup_time
                           AND pickup_time + INTERVAL 30 MINUTE) AS in_time
                  FROM pickups p LEFT JOIN dropoffs d ON p.trip_id = d.trip_id
                  GROUP BY p.trip_id, pickup_time)
            GROUP BY 1"""),
        "nearby_rides": _sql(_R, """
            SELECT r1.PULocationID AS zone_id, r1.event_time AS ride1_time,
                   r1.total_amount AS ride1_fare, r2.event_time AS ride2_time,
                   r2.total_amount AS ride2_fare,
                   date_sub('second', r1.event_time, r2.event_time) AS time_diff_seconds
            FROM rides r1 JOIN rides r2 ON r1.PULocationID = r2.PULocationID
              AND r2.event_time > r1.event_time
              AND r2.event_time <= r1.event_time + INTERVAL 5 MINUTE"""),
        "driver_buffer_join": _sql(["answered"], """
            SELECT event_id, driver_id, event_time, total_amount,
                   COALESCE(now_name, first_name) AS driver_name,
                   COALESCE(now_rating, first_rating) AS driver_rating
            FROM answered WHERE first_name IS NOT NULL"""),
        "driver_drop_if_old": _sql(["answered"], """
            SELECT event_id, driver_id, event_time, total_amount,
                   COALESCE(now_name, first_name) AS driver_name,
                   COALESCE(now_rating, first_rating) AS driver_rating
            FROM answered WHERE first_at <= event_time + INTERVAL 1 HOUR"""),
        "driver_emit_partial": _sql(["answered"], """
            SELECT event_id, driver_id, event_time, total_amount,
                   now_name AS driver_name, now_rating AS driver_rating FROM answered"""),
        "broadcast_enrich": _sql(["rides", "taxi_zones"], """
            SELECT r.*,
                   CASE WHEN pz.borough IS NULL OR pz.borough = 'ASIA' THEN 'Unknown'
                        ELSE pz.zone_name END AS pickup_zone,
                   CASE WHEN dz.borough IS NULL OR dz.borough = 'ASIA' THEN 'Unknown'
                        ELSE dz.zone_name END AS dropoff_zone
            FROM rides r LEFT JOIN taxi_zones pz ON PULocationID = pz.zone_id
            LEFT JOIN taxi_zones dz ON DOLocationID = dz.zone_id"""),
        "chained_enrich": _sql(["rides", "taxi_zones", "drivers"], """
            SELECT r.*, COALESCE(pz.zone_name, 'Unknown') AS pickup_zone,
                   COALESCE(dz.zone_name, 'Unknown') AS dropoff_zone,
                   d.name AS driver_name, d.rating AS driver_rating
            FROM rides r LEFT JOIN taxi_zones pz ON PULocationID = pz.zone_id
            LEFT JOIN taxi_zones dz ON DOLocationID = dz.zone_id
            LEFT JOIN drivers d ON r.driver_id = d.driver_id"""),
        "seed_load": _sql(["drivers"], """
            SELECT * FROM drivers UNION ALL
            SELECT driver_id, 'seed ' || name AS name, rating FROM all_drivers
            WHERE driver_id NOT IN (SELECT driver_id FROM drivers)"""),
        "upsert_latest": _sql(["driver_updates"], """
            SELECT * FROM driver_updates QUALIFY ROW_NUMBER() OVER (
              PARTITION BY driver_id ORDER BY updated_at DESC, update_id DESC) = 1"""),
        "avg_trip_duration": _sql(["day_trips"], f"""
            SELECT pickup_zone, COUNT(*) AS trip_count, {avg_duration} AS avg_duration_minutes
            FROM day_trips GROUP BY 1"""),
        "fraud_flags": _sql(["day_trips"], """
            SELECT * FROM (
              SELECT *, CAST(dropoff_time > pickup_time + INTERVAL 120 MINUTE AS INT) AS too_long,
                     CAST(pickup_zone = dropoff_zone AND fare > 50 AS INT) AS circular
              FROM day_trips)
            WHERE too_long = 1 OR circular = 1"""),
        "long_trips": _sql(["day_trips"], """
            SELECT * FROM day_trips WHERE dropoff_time > pickup_time + INTERVAL 120 MINUTE"""),
        "dashboard_named": _sql(["hours", "taxi_zones"], """
            SELECT h.zone_id, window_end, trip_count, total_revenue AS revenue,
                   COALESCE(zone_name, 'Unknown') AS zone_name
            FROM hours h LEFT JOIN taxi_zones z ON h.zone_id = z.zone_id"""),
        "dashboard_named_totals": _sql(["totals", "taxi_zones"], """
            SELECT t.zone_id, total_trips, total_revenue,
                   COALESCE(zone_name, 'Unknown') AS zone_name
            FROM totals t LEFT JOIN taxi_zones z ON t.zone_id = z.zone_id"""),
        "dashboard_named_stats": _sql(["rides", "taxi_zones"], f"""
            SELECT PULocationID AS zone_id, {avg_fare} AS avg_fare,
                   {avg_distance} AS avg_distance, COUNT(*) AS trip_count,
                   COALESCE(ANY_VALUE(zone_name), 'Unknown') AS zone_name
            FROM rides LEFT JOIN taxi_zones z ON PULocationID = z.zone_id GROUP BY 1"""),
        "late_observer": _sql(["observed"], "SELECT * FROM observed"),
        "late_side_output": _sql(["observed"], "SELECT * FROM observed WHERE status = 'LATE'"),
        "on_time_output": _sql(["observed"], "SELECT * FROM observed WHERE status = 'on-time'"),
        "late_count": _sql(["observed"], """
            SELECT 'late_events' AS stat_name, COUNT(*) FILTER (WHERE status = 'LATE')
                     AS stat_value FROM observed"""),
        "allowed_lateness": _sql(["observed"], _LATENESS.format(minutes=10)),
        "late_dropped": _sql(["observed"], _LATENESS.format(minutes=0)),
    }
