"""The queries of fairlead.plans.queries as SQL over the same parquet tables.

Voyages are read off islands of reports under way, cut into legs at gaps, and their stops are
found by an as-of join: another method than the engine's, so that each checks the other.
"""

STAGING = """staging AS (
  SELECT event_id + 1 AS position_id,
         ts AS gps_timestamp,
         CAST(200000000 + user_id AS VARCHAR) AS mmsi,
         CASE WHEN event_id % 101 = 0 THEN NULL
              ELSE CAST(user_id % 1800 AS DOUBLE) / 10 - 90 + CAST(event_id % 7 AS DOUBLE) / 100
         END AS latitude,
         CAST(event_id % 3600 AS DOUBLE) / 10 - 180 AS longitude,
         CASE event_type WHEN 'error' THEN 'Moored' WHEN 'signup' THEN 'At anchor'
              ELSE 'Engine' END AS nav_status,
         value AS speed_over_ground,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 360 AS DOUBLE) END AS heading,
         CAST((event_id * 7) % 360 AS DOUBLE) AS course_over_ground,
         CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL '1' DAY AS load_date
  FROM events)"""

DIMENSIONS = """ships AS (
  SELECT CAST(row_number() OVER (ORDER BY mmsi) AS BIGINT) AS id, mmsi
  FROM (SELECT DISTINCT mmsi FROM staging) k),
statuses AS (
  SELECT CAST(row_number() OVER (ORDER BY nav_status) AS BIGINT) AS id, nav_status
  FROM (SELECT DISTINCT nav_status FROM staging) k)"""

POSITIONS = """positions AS (
  SELECT s.position_id, s.longitude, s.latitude, ships.id AS ship_id, s.gps_timestamp,
         statuses.id AS nav_status_id, s.speed_over_ground AS sog, s.heading,
         s.course_over_ground AS cog, s.load_date
  FROM staging s
  LEFT JOIN ships ON s.mmsi = ships.mmsi
  LEFT JOIN statuses ON s.nav_status = statuses.nav_status
  WHERE s.longitude IS NOT NULL AND s.latitude IS NOT NULL)"""

BASE = ",\n".join([STAGING, DIMENSIONS, POSITIONS])

MARK = "TIMESTAMP '2024-01-16 00:00:00'"
FIRST_MARK = "TIMESTAMP '2024-01-02 00:00:00'"
OPEN_END = "TIMESTAMP '9999-12-31 00:00:00'"
NEWER = f"""newer AS (
  SELECT * FROM staging
  WHERE load_date > (SELECT coalesce(max(load_date), TIMESTAMP '1970-01-01 00:00:00')
                     FROM staging WHERE load_date <= {MARK}))"""


def series(source: str, name: str, gap: str = "15 minutes") -> str:
    """CTEs from reports to voyage limits, each with the given prefix.

    A ship's reports fall into islands of one kind, under way or not, and an island under way
    into legs wherever more than the gap lies between two reports. Voyages are read off the
    legs: a leg opens one unless the ship's reports begin with it; a leg that another one of its
    island follows closes with its last report, the last leg with the island after it.
    """
    ship = "PARTITION BY ship_id ORDER BY gps_timestamp, position_id"
    return f"""{name}_reports AS (
  SELECT p.ship_id, p.gps_timestamp, p.position_id, n.nav_status,
         n.nav_status IS NOT DISTINCT FROM 'Engine' AS active,
         row_number() OVER ({ship}) AS nth
  FROM {source} p LEFT JOIN statuses n ON p.nav_status_id = n.id),
{name}_islands AS (
  SELECT *, nth - row_number() OVER (PARTITION BY ship_id, active ORDER BY nth) AS island
  FROM {name}_reports),
{name}_legs AS (
  SELECT ship_id, gps_timestamp, position_id, nth, active, island,
         count(*) FILTER (active AND pause > INTERVAL '{gap}')
           OVER (PARTITION BY ship_id, active, island ORDER BY nth) AS leg
  FROM (SELECT *, gps_timestamp - lag(gps_timestamp)
                    OVER (PARTITION BY ship_id, active, island ORDER BY nth) AS pause
        FROM {name}_islands) i),
{name}_spans AS (
  SELECT ship_id, active, island, leg, min(nth) AS head, max(nth) AS tail,
         leg < max(leg) OVER (PARTITION BY ship_id, active, island) AS goes_on
  FROM {name}_legs GROUP BY ship_id, active, island, leg),
{name}_opening AS (
  SELECT ship_id, head AS nth, leg > 0 AS after_gap FROM {name}_spans
  WHERE active AND (leg > 0 OR head > 1)),
{name}_closing AS (
  SELECT ship_id, head AS nth, false AS before_gap FROM {name}_spans WHERE NOT active AND head > 1
  UNION ALL
  SELECT ship_id, tail, true FROM {name}_spans WHERE active AND goes_on),
{name}_boundaries AS (
  SELECT r.ship_id, r.gps_timestamp, r.position_id,
         CASE WHEN o.after_gap IS NULL THEN 0 ELSE 1 END AS start_trajectory,
         CASE WHEN c.before_gap IS NULL THEN 0 ELSE 1 END AS stop_trajectory
  FROM {name}_reports r
  LEFT JOIN {name}_opening o USING (ship_id, nth)
  LEFT JOIN {name}_closing c USING (ship_id, nth)
  LEFT JOIN (SELECT ship_id, min(nth) AS first_start FROM {name}_opening GROUP BY ship_id) f USING (ship_id)
  LEFT JOIN (SELECT ship_id, min(nth) AS first_stop FROM {name}_closing GROUP BY ship_id) g USING (ship_id)
  WHERE (o.after_gap IS NOT NULL OR c.before_gap IS NOT NULL)
    AND NOT (c.before_gap IS NOT NULL AND r.nth = least(f.first_start, g.first_stop))),
{name}_limits AS (
  SELECT a.ship_id, a.gps_timestamp AS datetime_start,
         coalesce(b.gps_timestamp, {OPEN_END}) AS datetime_stop,
         b.gps_timestamp IS NULL AS is_open
  FROM (SELECT DISTINCT ship_id, gps_timestamp FROM {name}_boundaries WHERE start_trajectory = 1) a
  ASOF LEFT JOIN (SELECT DISTINCT ship_id, gps_timestamp FROM {name}_boundaries
                  WHERE stop_trajectory = 1) b
    ON a.ship_id = b.ship_id AND a.gps_timestamp <= b.gps_timestamp)"""


def points(limits: str, name: str) -> str:
    return f"""{name} AS (
  SELECT l.ship_id, l.datetime_start, l.datetime_stop, p.position_id, p.gps_timestamp,
         p.longitude, p.latitude, p.sog, p.cog, p.heading,
         row_number() OVER v - 1 AS seq
  FROM {limits} l
  JOIN positions p ON l.ship_id = p.ship_id
   AND p.gps_timestamp BETWEEN l.datetime_start AND l.datetime_stop
  WINDOW v AS (PARTITION BY l.ship_id, l.datetime_start ORDER BY p.gps_timestamp, p.position_id))"""


def line_ends(source: str) -> str:
    return f"""SELECT v.ship_id, ships.mmsi, datetime_start, datetime_stop,
       CAST(count(*) AS BIGINT) AS n_points,
       CAST(sum(CASE WHEN heading IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null_heading,
       max(CASE WHEN seq = 0 THEN longitude END) AS first_lon,
       max(CASE WHEN seq = 0 THEN latitude END) AS first_lat,
       max(CASE WHEN seq = final THEN longitude END) AS last_lon,
       max(CASE WHEN seq = final THEN latitude END) AS last_lat,
       max(CASE WHEN seq = 0 THEN heading END) AS first_heading,
       max(CASE WHEN seq = final THEN heading END) AS last_heading
FROM (SELECT *, max(seq) OVER (PARTITION BY ship_id, datetime_start) AS final FROM {source}) v
LEFT JOIN ships ON v.ship_id = ships.id
GROUP BY v.ship_id, ships.mmsi, datetime_start, datetime_stop"""


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def dimension(key: str) -> str:
    return with_(
        STAGING,
        f"""known AS (
  SELECT CAST(row_number() OVER (ORDER BY {key}) AS BIGINT) AS id, {key}
  FROM (SELECT DISTINCT {key} FROM staging WHERE load_date <= {FIRST_MARK}) k)""",
        select=f"""SELECT id, {key} FROM known
UNION ALL
SELECT (SELECT max(id) FROM known) + CAST(row_number() OVER (ORDER BY {key}) AS BIGINT), {key}
FROM (SELECT DISTINCT {key} FROM staging
      WHERE load_date > {FIRST_MARK} AND {key} NOT IN (SELECT {key} FROM known)) k""",
    )


EARLIER = f"earlier AS (SELECT * FROM positions WHERE load_date <= {MARK})"
EARLIER_LIMITS = ",\n".join([EARLIER, series("earlier", "one")])
CLOSED = """closed AS (SELECT * FROM one_limits WHERE NOT is_open),
stored AS (SELECT ship_id, max(datetime_stop) AS last_stop FROM closed GROUP BY ship_id)"""
AFTER = """unread AS (
  SELECT p.* FROM positions p LEFT JOIN stored s ON p.ship_id = s.ship_id
  WHERE s.last_stop < p.gps_timestamp OR s.last_stop IS NULL)"""
LIMIT_COLUMNS = "ship_id, datetime_start, datetime_stop, is_open"
REPORT = "ship_id, gps_timestamp, position_id"
ALL = series("positions", "v")
WIDE = series("positions", "v", "12 hours")

SPOILT = """spoilt AS (
  SELECT gps_timestamp, CASE WHEN position_id % 97 = 0 THEN NULL ELSE mmsi END AS mmsi,
         latitude, longitude, nav_status, speed_over_ground, heading, course_over_ground,
         CASE WHEN position_id % 83 = 0 THEN 'gps_timestamp does not convert'
              WHEN position_id % 89 = 0 THEN 'latitude does not convert'
              WHEN position_id % 97 = 0 THEN 'mmsi is missing' END AS reason
  FROM staging)"""
INGESTED = """gps_timestamp, mmsi, latitude, longitude, nav_status,
       speed_over_ground AS sog, heading, course_over_ground AS cog"""

# In the warehouse, ships new in the second load get the ids after those of the first.
STORED_DIMENSIONS = f"""ships AS (
  SELECT CAST(row_number() OVER (ORDER BY load, mmsi) AS BIGINT) AS id, mmsi
  FROM (SELECT mmsi, CASE WHEN min(load_date) <= {MARK} THEN 1 ELSE 2 END AS load
        FROM staging GROUP BY mmsi) k),
statuses AS (
  SELECT CAST(row_number() OVER (ORDER BY load, nav_status) AS BIGINT) AS id, nav_status
  FROM (SELECT nav_status, CASE WHEN min(load_date) <= {MARK} THEN 1 ELSE 2 END AS load
        FROM staging GROUP BY nav_status) k)"""
STORED = ",\n".join([STAGING, STORED_DIMENSIONS, POSITIONS])

LINES = """SELECT pts.ship_id, ships.mmsi, datetime_start, datetime_stop, seq, gps_timestamp,
  longitude, latitude, sog, cog, heading FROM pts LEFT JOIN ships ON pts.ship_id = ships.id"""

ORACLES = {
    "staging_count": with_(STAGING, select="SELECT count(*) AS n FROM staging"),
    "ingest_strict": with_(STAGING, select=f"SELECT {INGESTED} FROM staging"),
    "ingest_lenient": with_(
        STAGING, SPOILT, select=f"SELECT {INGESTED} FROM spoilt WHERE reason IS NULL"
    ),
    "ingest_rejects": with_(
        STAGING,
        SPOILT,
        select="SELECT reason, count(*) AS n FROM spoilt WHERE reason IS NOT NULL GROUP BY reason",
    ),
    "new_rows_watermark": with_(
        STAGING, NEWER, select="SELECT position_id, mmsi, nav_status, load_date FROM newer"
    ),
    "new_row_range": with_(
        STAGING,
        NEWER,
        select="SELECT min(position_id) AS min_id, max(position_id) AS max_id FROM newer",
    ),
    "reject_rows": with_(
        STAGING,
        select="""SELECT position_id, reason FROM (
  SELECT position_id, CASE
    WHEN gps_timestamp IS NULL THEN 'gps_timestamp is missing'
    WHEN nav_status IS NULL THEN 'nav_status is missing'
    WHEN mmsi IS NULL THEN 'mmsi is missing'
    WHEN length(mmsi) > 20 THEN 'mmsi is too long'
    WHEN latitude IS NULL THEN 'latitude is missing'
    WHEN longitude IS NULL THEN 'longitude is missing' END AS reason FROM staging) r
WHERE reason IS NOT NULL""",
    ),
    "dim_ships": dimension("mmsi"),
    "dim_ships_spread": with_(STAGING, DIMENSIONS, select="SELECT id, mmsi FROM ships"),
    "dim_nav_statuses": dimension("nav_status"),
    "positions": with_(BASE, select="SELECT * FROM positions"),
    "positions_salted": with_(
        BASE,
        select="""SELECT * REPLACE (CASE WHEN position_id % 13 <> 0 THEN ship_id END AS ship_id)
FROM positions""",
    ),
    "dwh_update": with_(
        BASE,
        NEWER,
        select="""SELECT p.* FROM positions p
WHERE p.position_id BETWEEN (SELECT min(position_id) FROM newer)
                        AND (SELECT max(position_id) FROM newer)""",
    ),
    "deltas": with_(
        BASE,
        """numbered AS (
  SELECT p.ship_id, p.gps_timestamp, p.position_id, n.nav_status,
         row_number() OVER (PARTITION BY p.ship_id ORDER BY p.gps_timestamp, p.position_id) AS nth
  FROM positions p LEFT JOIN statuses n ON p.nav_status_id = n.id)""",
        select="""SELECT b.ship_id, b.gps_timestamp, b.position_id, b.nav_status,
  a.nav_status AS nav_status_prev,
  CAST(epoch_us(b.gps_timestamp) - epoch_us(a.gps_timestamp) AS DOUBLE) / 1e6 AS delta_seconds
FROM numbered b LEFT JOIN numbered a ON a.ship_id = b.ship_id AND a.nth + 1 = b.nth""",
    ),
    "transitions": with_(
        BASE,
        ALL,
        select="""SELECT r.ship_id, r.gps_timestamp, r.position_id,
  CASE WHEN NOT o.after_gap THEN 1 ELSE 0 END AS start_engine,
  CASE WHEN NOT c.before_gap THEN 1 ELSE 0 END AS stop_engine,
  CASE WHEN o.after_gap THEN 1 ELSE 0 END AS start_after_gap
FROM v_reports r
LEFT JOIN v_opening o USING (ship_id, nth) LEFT JOIN v_closing c USING (ship_id, nth)""",
    ),
    "boundaries": with_(
        BASE,
        ALL,
        select=f"SELECT {REPORT}, start_trajectory, stop_trajectory FROM v_boundaries",
    ),
    "voyage_limits": with_(BASE, ALL, select=f"SELECT {LIMIT_COLUMNS} FROM v_limits"),
    "voyage_limits_cut": with_(BASE, ALL, select=f"SELECT {LIMIT_COLUMNS} FROM v_limits"),
    "voyage_limits_wide_gap": with_(BASE, WIDE, select=f"SELECT {LIMIT_COLUMNS} FROM v_limits"),
    "voyage_points": with_(
        BASE,
        ALL,
        points("v_limits", "pts"),
        select="""SELECT ship_id, datetime_start, seq, gps_timestamp, longitude, latitude,
  sog, cog, heading FROM pts""",
    ),
    "trajectory_vectors": with_(
        BASE,
        ALL,
        points("v_limits", "pts"),
        select=LINES,
    ),
    "trajectory_vectors_cut": with_(BASE, ALL, points("v_limits", "pts"), select=LINES),
    "trajectory_parts": with_(
        BASE,
        WIDE,
        points("v_limits", "pts"),
        select="""SELECT pts.ship_id, ships.mmsi, datetime_start, CAST(seq // 3 AS BIGINT) AS part,
  count(*) AS n_points, max(gps_timestamp) AS last_report
FROM pts LEFT JOIN ships ON pts.ship_id = ships.id
GROUP BY pts.ship_id, ships.mmsi, datetime_start, seq // 3""",
    ),
    "trajectory_range": with_(
        BASE,
        ALL,
        points(
            "(SELECT * FROM v_limits WHERE ship_id <= (SELECT count(*) // 2 FROM ships))", "pts"
        ),
        select=line_ends("pts"),
    ),
    "trajectory_export": with_(BASE, WIDE, points("v_limits", "pts"), select=line_ends("pts")),
    "export_one_ship": with_(
        BASE,
        ALL,
        """busiest AS (
  SELECT ship_id FROM positions GROUP BY ship_id ORDER BY count(*) DESC, ship_id LIMIT 1)""",
        points("(SELECT * FROM v_limits WHERE ship_id = (SELECT ship_id FROM busiest))", "pts"),
        select=line_ends("pts"),
    ),
    "find_and_export": with_(
        BASE,
        ALL,
        EARLIER_LIMITS,
        CLOSED,
        """found AS (
  SELECT * FROM v_limits WHERE (ship_id, datetime_start) NOT IN (
    SELECT (ship_id, datetime_start) FROM closed))""",
        points("found", "pts"),
        select=line_ends("pts"),
    ),
    "voyage_incremental": with_(
        BASE,
        EARLIER_LIMITS,
        CLOSED,
        AFTER,
        series("unread", "two"),
        select=f"""SELECT {LIMIT_COLUMNS} FROM closed
UNION ALL SELECT {LIMIT_COLUMNS} FROM two_limits""",
    ),
    "voyage_incremental_carry": with_(BASE, ALL, select=f"SELECT {LIMIT_COLUMNS} FROM v_limits"),
    "late_positions": with_(
        BASE,
        EARLIER_LIMITS,
        CLOSED,
        f"""arrived AS (
  SELECT ship_id, position_id, load_date,
         CASE WHEN position_id % 50 = 0 AND load_date > {MARK}
              THEN gps_timestamp - INTERVAL '20' DAY ELSE gps_timestamp END AS gps_timestamp
  FROM positions)""",
        select=f"""SELECT a.ship_id, a.position_id, a.gps_timestamp
FROM arrived a JOIN stored s ON a.ship_id = s.ship_id
WHERE a.load_date > {MARK} AND a.gps_timestamp <= s.last_stop""",
    ),
    "warehouse_positions": with_(STORED, select="SELECT * FROM positions"),
    "warehouse_exports": with_(
        STORED,
        ALL,
        points("v_limits", "pts"),
        select=LINES,
    ),
    "warehouse_limits": with_(STORED, ALL, select=f"SELECT {LIMIT_COLUMNS} FROM v_limits"),
    "ingest_mixed_headers": with_(
        STAGING,
        select=f"SELECT {INGESTED}, {MARK} AS load_date, CAST(1 AS BIGINT) AS rows_of_id FROM staging",
    ),
    "trajectory_lines": with_(
        BASE,
        WIDE,
        points("v_limits", "pts"),
        select="""SELECT pts.ship_id, ships.mmsi, datetime_start, CAST(seq // 3 AS BIGINT) AS part,
  count(*) OVER (PARTITION BY pts.ship_id, datetime_start) AS n_parts,
  'LINESTRING (' || string_agg(longitude || ' ' || latitude, ', ' ORDER BY seq) || ')' AS line
FROM pts LEFT JOIN ships ON pts.ship_id = ships.id
GROUP BY pts.ship_id, ships.mmsi, datetime_start, seq // 3""",
    ),
    "warehouse_full_recompute": with_(
        BASE,
        f"kept AS (SELECT * FROM positions WHERE load_date <= {MARK} OR position_id % 7 <> 0)",
        series("kept", "v"),
        select="""SELECT mmsi, datetime_start, datetime_stop, is_open
FROM v_limits JOIN ships ON ships.id = v_limits.ship_id""",
    ),
    "warehouse_repeat": with_(
        STORED, select=f"SELECT * FROM positions WHERE load_date <= {MARK} OR position_id % 7 <> 0"
    ),
    "warehouse_voyage_ids": with_(
        STORED,
        ALL,
        EARLIER_LIMITS,
        f"""one AS (
  SELECT *, row_number() OVER (ORDER BY ship_id, datetime_start) AS id FROM one_limits),
stay AS (
  SELECT * FROM one WHERE NOT is_open
     OR ship_id NOT IN (SELECT ship_id FROM positions WHERE load_date > {MARK}))""",
        select="""SELECT id, ship_id, datetime_start, is_open FROM stay
UNION ALL
SELECT (SELECT count(*) FROM one) + row_number() OVER (ORDER BY ship_id, datetime_start),
       ship_id, datetime_start, is_open
FROM v_limits ANTI JOIN stay USING (ship_id, datetime_start)""",
    ),
    "dq_all_rules": with_(
        BASE,
        ALL,
        """spoilt AS (
  SELECT position_id, latitude,
         CASE WHEN position_id % 211 = 0 THEN rpad(mmsi, 21, '0')
              WHEN position_id % 97 <> 0 THEN mmsi END AS mmsi,
         CASE WHEN position_id % 89 <> 0 THEN nav_status END AS nav_status,
         CASE WHEN position_id % 83 <> 0 THEN gps_timestamp END AS gps_timestamp,
         CASE WHEN position_id % 79 <> 0 THEN longitude END AS longitude
  FROM staging),
known AS (SELECT id, mmsi FROM ships WHERE id % 5 > 0),
kept AS (SELECT * FROM v_limits WHERE ship_id % 13 > 0)""",
        select="""SELECT 'ship listed twice' AS rule, count(*) AS broken FROM known WHERE id % 7 = 0
UNION ALL SELECT 'status listed twice', count(*) FROM statuses WHERE id = 2
UNION ALL SELECT 'position without point', count(*) FROM positions WHERE position_id % 73 = 0
UNION ALL SELECT 'position of unknown ship', count(*) FROM positions
  WHERE ship_id NOT IN (SELECT id FROM known)
UNION ALL SELECT 'position of unknown status', count(*) FROM positions WHERE nav_status_id = 1
UNION ALL SELECT 'voyage without limits', count(*) FROM kept WHERE ship_id % 11 = 0
UNION ALL SELECT 'voyage of unknown ship', count(*) FROM kept
  WHERE ship_id NOT IN (SELECT id FROM known)
UNION ALL SELECT 'line of unknown voyage', count(*) FROM v_limits WHERE ship_id % 13 = 0
UNION ALL SELECT 'staging: ' || reason, count(*) FROM (
  SELECT CASE
    WHEN gps_timestamp IS NULL THEN 'gps_timestamp is missing'
    WHEN nav_status IS NULL THEN 'nav_status is missing'
    WHEN mmsi IS NULL THEN 'mmsi is missing'
    WHEN length(mmsi) > 20 THEN 'mmsi is too long'
    WHEN latitude IS NULL THEN 'latitude is missing'
    WHEN longitude IS NULL THEN 'longitude is missing' END AS reason FROM spoilt) r
WHERE reason IS NOT NULL GROUP BY reason""",
    ),
    "dq_duplicate_keys": with_(
        STAGING, select="SELECT mmsi, count(*) AS n FROM staging GROUP BY mmsi HAVING count(*) > 1"
    ),
    "dq_orphans": with_(
        STAGING,
        select=f"""SELECT position_id, mmsi FROM staging s
WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND mmsi NOT IN (
  SELECT mmsi FROM staging WHERE load_date <= {FIRST_MARK})""",
    ),
    "dq_constraints": with_(
        BASE,
        ALL,
        f"""known AS (
  SELECT * FROM ships
  WHERE mmsi IN (SELECT mmsi FROM staging WHERE load_date <= {FIRST_MARK}))""",
        select="""SELECT 'ship listed twice' AS rule, count(*) AS broken
  FROM (SELECT mmsi FROM known GROUP BY mmsi HAVING count(*) > 1) d
UNION ALL SELECT 'status listed twice', count(*)
  FROM (SELECT nav_status FROM statuses GROUP BY nav_status HAVING count(*) > 1) d
UNION ALL SELECT 'position without point', count(*)
  FROM positions WHERE longitude IS NULL OR latitude IS NULL
UNION ALL SELECT 'position of unknown ship', count(*)
  FROM positions WHERE ship_id NOT IN (SELECT id FROM known)
UNION ALL SELECT 'position of unknown status', count(*)
  FROM positions WHERE nav_status_id NOT IN (SELECT id FROM statuses)
UNION ALL SELECT 'voyage without limits', count(*)
  FROM v_limits WHERE datetime_start IS NULL OR datetime_stop IS NULL
UNION ALL SELECT 'voyage of unknown ship', count(*)
  FROM v_limits WHERE ship_id NOT IN (SELECT id FROM known)
UNION ALL SELECT 'staging: latitude is missing', count(*)
  FROM staging WHERE latitude IS NULL HAVING count(*) > 0""",
    ),
}
