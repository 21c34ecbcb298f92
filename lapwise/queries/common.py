"""SQL fragments of the bound tables, for the oracle side of each registered query."""

from __future__ import annotations

CTES: dict[str, tuple[list[str], str]] = {
    "races": (
        [],
        """SELECT o_orderkey AS raceId, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS round, o_orderpriority AS name,
           CAST(o_custkey % 25 AS INTEGER) AS circuitId, CAST(o_orderdate AS DATE) AS date FROM orders""",
    ),
    "raw_races": (
        [],
        """SELECT o_orderkey AS raceId, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS round,
           CASE o_custkey % 25 WHEN 0 THEN 'Monaco' WHEN 1 THEN 'Singapore' WHEN 2 THEN 'Baku'
             WHEN 3 THEN 'Melbourne' WHEN 4 THEN 'Belgium' ELSE o_orderpriority END || ' Grand Prix' AS name,
           CAST(o_custkey % 25 AS VARCHAR) AS circuitId, strftime(o_orderdate, '%Y-%m-%d') AS date,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 24 END AS h, o_orderkey % 60 AS m,
           (o_orderkey // 60) % 60 AS s FROM orders""",
    ),
    "drivers": (
        [],
        """SELECT s_suppkey AS driverId, split_part(s_name, '#', 1) AS forename, split_part(s_name, '#', 2) AS surname,
           n_name AS nationality, CAST(DATE '1960-01-01' + CAST(s_suppkey * 37 % 16000 AS INTEGER) AS DATE) AS dob
           FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "constructors": (
        [],
        """SELECT p_brand AS constructorId, p_brand AS constructorName, min(p_type) AS constructorNationality
           FROM part GROUP BY p_brand""",
    ),
    "circuits": (
        [],
        """SELECT n_nationkey AS circuitId, n_name AS name, r_name AS location,
           CASE r_name WHEN 'EUROPE' THEN 'Italy' WHEN 'AMERICA' THEN 'Brazil' WHEN 'ASIA' THEN 'Japan'
             WHEN 'MIDDLE EAST' THEN 'UAE' ELSE n_name END AS country,
           CASE r_name WHEN 'EUROPE' THEN 'Europe' WHEN 'AMERICA' THEN 'Americas' WHEN 'ASIA' THEN 'Asia-Pacific'
             WHEN 'MIDDLE EAST' THEN 'Asia-Pacific' ELSE 'Other' END AS circuit_region,
           n_nationkey * CAST(8 AS DOUBLE) - 96 AS lat, n_nationkey * CAST(16 AS DOUBLE) - 190 AS lng
           FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "results": (
        [],
        """SELECT l_orderkey AS raceId, l_suppkey AS driverId, p_brand AS constructorId,
           CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS position,
           CASE WHEN l_returnflag = 'R' THEN 'R' ELSE CAST(l_linenumber AS VARCHAR) END AS positionText,
           l_linenumber AS positionOrder, l_quantity AS points, p_size AS laps,
           CAST(round(l_discount * 100) AS INTEGER) AS fastestLap
           FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
    "facts": (
        ["results", "races"],
        """SELECT r.*, y.year, r.positionText IN ('1','2','3','4','5','6','7','8','9','10','11','12','13','14','15',
             '16','17','18','19','20') AS finished_race,
           coalesce(r.position IN (1, 2, 3), false) AS podium_finish, r.positionText IN ('R', 'D', 'F') AS dnf_status
           FROM results r JOIN races y ON r.raceId = y.raceId
           WHERE (position IS NULL OR position BETWEEN 1 AND 50) AND points BETWEEN 0 AND 50 AND laps BETWEEN 1 AND 100""",
    ),
    "performance": (
        ["facts", "races", "drivers", "constructors"],
        """SELECT f.raceId, f.driverId, f.constructorId, f.position, f.positionText, f.points, f.laps,
           f.finished_race, f.podium_finish, f.dnf_status, f.fastestLap, f.year, y.round, y.name, y.circuitId,
           d.forename, d.surname, d.nationality, c.constructorName, c.constructorNationality
           FROM facts f JOIN races y ON f.raceId = y.raceId JOIN drivers d ON f.driverId = d.driverId
           JOIN constructors c ON f.constructorId = c.constructorId""",
    ),
    "driver_statistics": (
        ["performance"],
        """SELECT *, total_wins / total_races AS win_rate, total_podiums / total_races AS podium_rate,
           dnf_count / total_races AS dnf_rate, total_points / total_races AS points_per_race,
           (total_races - dnf_count) / total_races AS finish_rate,
           CASE WHEN position_stddev IS NOT NULL THEN 1 - position_stddev / average_finish_position ELSE 0.0 END
             AS consistency_score
           FROM (SELECT driverId, forename, surname, nationality, constructorId, constructorName, year,
             count(raceId) AS total_races,
             count(*) FILTER (WHERE position = 1) AS total_wins, count(*) FILTER (WHERE podium_finish) AS total_podiums,
             sum(points) AS total_points, avg(position) FILTER (WHERE finished_race) AS average_finish_position,
             count(*) FILTER (WHERE dnf_status) AS dnf_count, count(*) FILTER (WHERE fastestLap = 1) AS fastest_laps,
             min(position) AS career_best_position, max(position) AS career_worst_position,
             stddev_samp(position) FILTER (WHERE finished_race) AS position_stddev
             FROM performance GROUP BY ALL)""",
    ),
    "driver_seasons": (
        ["performance"],
        """SELECT *, total_wins / total_races AS win_rate, total_podiums / total_races AS podium_rate,
           dnf_count / total_races AS dnf_rate, total_points / total_races AS points_per_race,
           (total_races - dnf_count) / total_races AS finish_rate,
           CASE WHEN position_stddev IS NOT NULL THEN 1 - position_stddev / average_finish_position ELSE 0.0 END
             AS consistency_score
           FROM (SELECT driverId, forename, surname, nationality, year, count(raceId) AS total_races,
             count(*) FILTER (WHERE position = 1) AS total_wins, count(*) FILTER (WHERE podium_finish) AS total_podiums,
             sum(points) AS total_points, avg(position) FILTER (WHERE finished_race) AS average_finish_position,
             count(*) FILTER (WHERE dnf_status) AS dnf_count, count(*) FILTER (WHERE fastestLap = 1) AS fastest_laps,
             min(position) AS career_best_position, max(position) AS career_worst_position,
             stddev_samp(position) FILTER (WHERE finished_race) AS position_stddev
             FROM performance GROUP BY ALL)""",
    ),
    "standings": (
        ["driver_seasons"],
        """SELECT driverId, forename, surname, nationality, year, championship_position, total_points, total_wins,
           total_podiums, total_races, total_points - leader_points AS points_gap_to_leader,
           CASE WHEN leader_points - total_points <= 25 THEN 'Contender'
             WHEN leader_points - total_points <= 50 THEN 'Dark Horse' ELSE 'Out of Contention' END
             AS championship_battle_status, win_rate, podium_rate, consistency_score
           FROM (SELECT *, CAST(row_number() OVER (PARTITION BY year ORDER BY total_points DESC, total_wins DESC,
             total_podiums DESC, driverId) AS INTEGER) AS championship_position,
             max(total_points) OVER (PARTITION BY year) AS leader_points FROM driver_seasons)""",
    ),
    "constructor_rankings": (
        ["performance"],
        """SELECT *, total_wins / total_races AS team_win_rate, total_podiums / total_races AS team_podium_rate,
           total_points / total_races AS points_per_race,
           (total_wins * 25 + total_podiums * 18 + total_points) / total_races AS dominance_score
           FROM (SELECT constructorId, constructorName, constructorNationality, year, count(raceId) AS total_races,
             count(*) FILTER (WHERE position = 1) AS total_wins, count(*) FILTER (WHERE podium_finish) AS total_podiums,
             sum(points) AS total_points, count(DISTINCT driverId) AS driver_count,
             avg(position) FILTER (WHERE finished_race) AS average_team_position FROM performance GROUP BY ALL)""",
    ),
    "consistency": (
        ["driver_statistics"],
        """SELECT *, CASE WHEN round(position_variance, 9) < 2 THEN 'Very Consistent'
             WHEN round(position_variance, 9) < 5 THEN 'Consistent' WHEN round(position_variance, 9) < 10 THEN 'Inconsistent'
             ELSE 'Very Inconsistent' END AS consistency_rating,
           CASE WHEN round(rolling_average_position, 9) < 10 THEN 'Good Form'
             WHEN round(rolling_average_position, 9) < 15 THEN 'Average Form' ELSE 'Poor Form' END AS form_trend
           FROM (SELECT *, avg(average_finish_position) OVER w AS rolling_average_position,
             sum(total_points) OVER w AS rolling_points, var_samp(average_finish_position) OVER w AS position_variance
             FROM driver_statistics
             WINDOW w AS (PARTITION BY driverId ORDER BY year, constructorId ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))""",
    ),
    "qualifying": (
        [],
        """SELECT l_orderkey AS raceId, l_suppkey AS driverId, CAST(row_number() OVER (PARTITION BY l_orderkey
             ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS INTEGER) AS position FROM lineitem""",
    ),
    "laps": (
        [],
        """SELECT date_diff('day', DATE '2023-12-31', CAST(ts AS DATE)) AS raceId, user_id AS driverId,
           CAST(year(ts) AS INTEGER) AS year,
           CAST(row_number() OVER w AS INTEGER) AS lap, CAST(round(value * 1000) AS BIGINT) AS milliseconds,
           event_type = 'purchase' AS in_pit,
           CAST(count(*) FILTER (WHERE event_type = 'purchase') OVER w AS INTEGER) AS stop
           FROM events WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    ),
    "pit_stops": (["laps"], "SELECT raceId, driverId, stop, lap, milliseconds FROM laps WHERE in_pit"),
    "race_teams": (
        ["results"],
        "SELECT raceId, driverId, min(constructorId) AS constructorId FROM results GROUP BY raceId, driverId",
    ),
    "pit_analysis": (
        ["pit_stops", "races", "drivers", "race_teams"],
        """SELECT p.raceId, p.driverId, t.constructorId, p.stop, p.milliseconds,
           p.milliseconds / 1000.0 AS pit_duration_seconds,
           CASE WHEN p.milliseconds < 20000 THEN 'Fast' WHEN p.milliseconds < 25000 THEN 'Normal'
             WHEN p.milliseconds < 30000 THEN 'Slow' ELSE 'Very Slow' END AS pit_time_category,
           y.year, y.round, y.name, y.circuitId, d.forename, d.surname, d.nationality
           FROM pit_stops p JOIN races y ON p.raceId = y.raceId JOIN drivers d ON p.driverId = d.driverId
           LEFT JOIN race_teams t ON p.raceId = t.raceId AND p.driverId = t.driverId
           WHERE p.stop BETWEEN 1 AND 10 AND p.milliseconds BETWEEN 1000 AND 300000""",
    ),
    "lap_trends": (
        ["laps", "races", "race_teams"],
        """SELECT l.raceId, y.year, l.driverId, t.constructorId, fastest_lap_time, slowest_lap_time, average_lap_time,
           total_laps, lap_time_stddev, 1 - lap_time_stddev / average_lap_time AS pace_consistency,
           (slowest_lap_time - fastest_lap_time) / total_laps AS lap_degradation_rate,
           (average_lap_time - fastest_lap_time) / average_lap_time AS pace_improvement_potential
           FROM (SELECT raceId, driverId, min(milliseconds) AS fastest_lap_time, max(milliseconds) AS slowest_lap_time,
             CAST(sum(milliseconds) AS DOUBLE) / count(*) AS average_lap_time, count(lap) AS total_laps,
             stddev_samp(milliseconds) AS lap_time_stddev FROM laps GROUP BY raceId, driverId) l
           JOIN races y ON l.raceId = y.raceId
           LEFT JOIN race_teams t ON l.raceId = t.raceId AND l.driverId = t.driverId""",
    ),
    "pit_efficiency": (
        ["pit_analysis", "constructors"],
        """SELECT p.*, c.constructorName, 10000 / average_pit_time AS pit_efficiency_score,
           1 - (slowest_pit_time - fastest_pit_time) / average_pit_time AS pit_consistency,
           total_pit_time / 1000.0 AS time_lost_in_pits
           FROM (SELECT raceId, year, driverId, constructorId, count(stop) AS total_pit_stops,
             min(milliseconds) AS fastest_pit_time, max(milliseconds) AS slowest_pit_time,
             CAST(sum(milliseconds) AS DOUBLE) / count(*) AS average_pit_time,
             CAST(sum(milliseconds) AS BIGINT) AS total_pit_time FROM pit_analysis GROUP BY ALL) p
           LEFT JOIN constructors c ON p.constructorId = c.constructorId""",
    ),
    "race_pace": (
        ["performance", "laps"],
        """SELECT p.raceId, p.year, p.driverId, p.constructorId, p.position,
           CAST(sum(l.milliseconds) AS DOUBLE) / count(l.milliseconds) AS average_race_lap_time,
           min(l.milliseconds) AS fastest_race_lap, max(l.lap) AS total_race_laps
           FROM (SELECT DISTINCT raceId, year, driverId, constructorId, position FROM performance) p
           LEFT JOIN laps l ON p.raceId = l.raceId AND p.driverId = l.driverId GROUP BY ALL""",
    ),
    "qvr": (
        ["qualifying", "performance"],
        """SELECT q.raceId, p.year, q.driverId, p.constructorId, q.position AS qualifying_position,
           p.position AS race_position, q.position - p.position AS position_change,
           CASE WHEN q.position > p.position THEN q.position - p.position ELSE 0 END AS overtakes_made,
           CASE WHEN q.position < p.position THEN p.position - q.position ELSE 0 END AS positions_lost,
           CASE WHEN q.position <= 3 THEN 10 WHEN q.position <= 10 THEN 5 ELSE 1 END AS qualifying_performance_score,
           p.forename, p.surname, p.nationality, p.constructorName, p.constructorNationality
           FROM (SELECT raceId, driverId, min(position) AS position FROM qualifying GROUP BY ALL) q
           JOIN performance p ON q.raceId = p.raceId AND q.driverId = p.driverId""",
    ),
}


def sql(body: str, *needs: str, **extra: str) -> str:
    """``body`` under the fragments it needs; ``extra`` adds fragments of its own after them."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for dep in CTES[name][0]:
                visit(dep)
            ordered.append(name)

    for name in needs:
        visit(name)
    parts = [f"{name} AS ({CTES[name][1]})" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body
