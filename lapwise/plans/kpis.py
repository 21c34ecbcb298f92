"""Key figures that are only described, not computed, elsewhere; the definitions are stated here.

All of them aggregate before they join or rank, and none pairs the members of a group with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapwise import constants as C
from lapwise.functions import metrics as M
from lapwise.operators.running import framed, row_numbers, running_totals


def pace_index(laps: DataFrame) -> DataFrame:
    """Mean lap of a driver's season minus the mean lap of all laps of that season, relative to the latter."""
    own = laps.groupBy("driverId", "year").agg(F.sum("milliseconds").alias("ms"), F.count("milliseconds").alias("laps"))
    season = own.groupBy("year").agg(M.ratio(F.sum("ms"), F.sum("laps")).alias("season_average"))
    mean = M.ratio(F.col("ms"), F.col("laps"))
    return own.join(season, "year").select(
        "driverId", "year", "laps", mean.alias("driver_average"), "season_average",
        M.ratio(mean - F.col("season_average"), F.col("season_average")).alias("pace_index"),
    )


def undercut_efficiency(stops: DataFrame, places: DataFrame) -> DataFrame:
    """Share of later-stopping rivals a driver finishes ahead of.

    A rival makes the same numbered stop of the same race on a later lap; only classified drivers (place 1 or worse)
    count. Drivers are not paired. A worse place is larger, so at the first binary digit in which it differs it has 1
    where the driver's place has 0: for each digit, stops with 1 are counted under the digits above, and a stop with 0
    there adds up the counts of later laps under its own digits above. There are as many digits as the worst place
    needs, and stops are counted per place before they are spread over them.
    """
    stop = ["raceId", "stop"]
    placed = stops.join(places.filter(F.col("position") >= 1), ["raceId", "driverId"]).select(
        *stop, "lap", "driverId", F.col("position").cast("long").alias("position")
    )
    worst = F.length(F.bin(placed.agg(F.max("position")).scalar()))
    digits = F.explode(F.sequence(F.lit(0), F.coalesce(worst, F.lit(1)) - 1)).alias("digit")
    shifted = F.expr("shiftright(position, digit)")

    def by_digit(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.select(*stop, "lap", *columns, "position", digits).select(
            *stop, "lap", *columns, "digit", F.expr("shiftright(position, digit + 1)").alias("above"),
            (shifted % 2 == 1).alias("one"),
        )

    counted = placed.groupBy(*stop, "lap", "position").agg(F.count(F.lit(1)).alias("stops"))
    all_later = _later(placed, stop).join(placed, [*stop, "lap"]).groupBy("driverId").agg(F.sum("later").alias("rivals"))
    under = [*stop, "digit", "above"]
    waits = by_digit(placed, "driverId").filter("not one").groupBy(*under, "lap", "driverId").count()
    marks = by_digit(counted, "stops").withColumn("weight", F.when(F.col("one"), F.col("stops")).otherwise(F.lit(0)))
    beaten = (
        _later(marks, under, F.sum("weight")).join(waits, [*under, "lap"])
        .groupBy("driverId").agg(F.sum(F.col("later") * F.col("count")).alias("beaten"))
    )
    return (
        all_later.filter("rivals > 0").join(beaten, "driverId", "left").na.fill(0, ["beaten"])
        .withColumn("undercut_efficiency", M.ratio(F.col("beaten"), F.col("rivals")))
    )


def _later(rows: DataFrame, keys: list[str], count: Column | None = None) -> DataFrame:
    """Per key and lap, the rows (or their weight) of later laps; laps are counted in cells of a thousand."""
    counted = F.count(F.lit(1)) if count is None else count
    laps = rows.groupBy(*keys, "lap").agg(counted.alias("own"))
    totals = running_totals(laps, keys, [F.desc("lap")], {"upto": F.col("own")}, [F.floor(-F.col("lap") / 1000)])
    return totals.select(*keys, "lap", (F.col("upto") - F.col("own")).alias("later"))


def with_tyre_age(laps: DataFrame, stops: DataFrame) -> DataFrame:
    """Laps with their stint (stops made so far, the lap of the stop included) and tyre age, which starts at 1.

    The laps of one driver in one race are cut by thousands, so also a race without end is counted in pieces.
    """
    race = ["raceId", "driverId"]
    marks = stops.groupBy(*race, "lap").agg(F.count(F.lit(1)).alias("_stops"))
    flagged = laps.join(marks, [*race, "lap"], "left").na.fill(0, ["_stops"])
    stints = running_totals(
        flagged, race, [F.asc("lap")], {"stint": F.col("_stops")}, [F.floor(F.col("lap") / 1000)]
    ).drop("_stops")
    starts = stints.groupBy(*race, "stint").agg(F.min("lap").alias("_start"))
    return (
        stints.join(starts, [*race, "stint"]).withColumn("tyre_age", F.col("lap") - F.col("_start") + 1).drop("_start")
    )


def weighted_consistency(aged_laps: DataFrame) -> DataFrame:
    """One minus the deviation of lap times relative to their mean, both weighted by tyre age, per driver season."""
    w, x = F.col("tyre_age").cast("double"), F.col("milliseconds").cast("double")
    sums = aged_laps.groupBy("driverId", "year").agg(
        F.sum(w).alias("w"), F.sum(w * x).alias("wx"), F.sum(w * x * x).alias("wxx"), F.count(F.lit(1)).alias("laps")
    )
    mean = F.col("wx") / F.col("w")
    deviation = F.sqrt(F.greatest(F.lit(0.0), F.col("wxx") / F.col("w") - mean * mean))
    return sums.select(
        "driverId", "year", "laps", mean.alias("weighted_mean"), deviation.alias("weighted_stddev"),
        (1 - M.ratio(deviation, mean)).alias("consistency"),
    )


def reliability(facts: DataFrame, half_life_years: float = 1.0) -> DataFrame:
    """Share of a team's race weekends without a retirement; a season weighs half of the one after it."""
    weekends = facts.groupBy("constructorId", "year", "raceId").agg(F.max("dnf_status").alias("retired"))
    seasons = weekends.groupBy("constructorId", "year").agg(
        F.count(F.lit(1)).alias("weekends"), F.count_if(~F.col("retired")).alias("clean")
    )
    last = seasons.groupBy("constructorId").agg(F.max("year").alias("last_year"))
    weight = F.pow(F.lit(0.5), (F.col("last_year") - F.col("year")) / half_life_years)
    return (
        seasons.join(last, "constructorId")
        .groupBy("constructorId")
        .agg(
            F.sum("weekends").alias("weekends"),
            M.ratio(F.sum(weight * F.col("clean")), F.sum(weight * F.col("weekends"))).alias("reliability"),
        )
    )


def fastest_laps(laps: DataFrame, races: DataFrame) -> DataFrame:
    """Fastest and mean lap per circuit and year; laps are cut to one row per race before the join."""
    per_race = laps.groupBy("raceId").agg(
        F.min("milliseconds").alias("ms_min"), F.sum("milliseconds").alias("ms_sum"), F.count("milliseconds").alias("n")
    )
    return (
        per_race.join(races.select("raceId", "circuitId", "year"), "raceId")
        .groupBy("circuitId", "year")
        .agg(
            F.min("ms_min").alias("fastest_lap"), M.ratio(F.sum("ms_sum"), F.sum("n")).alias("average_lap"),
            F.sum("n").alias("laps"),
        )
    )


def pit_benchmarks(pits: DataFrame) -> DataFrame:
    return pits.groupBy("constructorId").agg(
        F.count(F.lit(1)).alias("stops"), F.min("milliseconds").alias("fastest_stop"),
        F.avg("milliseconds").alias("average_stop"),
    )


def season_benchmarks(seasons: DataFrame) -> DataFrame:
    """Best driver and averages of each season; the best is a mergeable maximum, ties to the smaller id."""
    best = F.max_by("driverId", F.struct("total_points", -F.col("driverId")))
    return seasons.groupBy("year").agg(
        best.alias("best_driver"), F.max("total_points").alias("best_points"),
        F.avg("total_points").alias("average_points"), F.avg("win_rate").alias("average_win_rate"),
    )


def grid_statistics(qualifying_vs_race: DataFrame) -> DataFrame:
    """Correlation and regression of finish on grid position per team."""
    y, x = F.col("race_position"), F.col("qualifying_position")
    both = qualifying_vs_race.filter(y.isNotNull() & x.isNotNull())
    return both.groupBy("constructorId").agg(
        F.count(F.lit(1)).alias("results"), F.corr(y, x).alias("correlation"),
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
    )


def rank_correlation(rows: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """Spearman's rank correlation of two numeric columns per group; equal values share the mean of their ranks.

    Rows are counted per pair of values first. Ranks come from running counts over the distinct values of a group, cut by
    thousands, so no task holds a group. Rows without key, ``x`` or ``y`` take no part; a group whose ``x`` or ``y`` never
    varies has no correlation.
    """
    known = rows.filter(F.col(key).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = known.groupBy(key, x, y).agg(F.count(F.lit(1)).alias("n"))

    def ranks(name: str) -> DataFrame:
        own = pairs.groupBy(key, name).agg(F.sum("n").alias("own"))
        upto = running_totals(own, [key], [F.asc(name)], {"upto": F.col("own")}, [F.floor(F.col(name) / 1000)])
        return upto.select(key, name, (F.col("upto") - (F.col("own") - 1) / 2).alias(f"rank_{name}"))

    # Around their known mean the ranks add up without loss.
    centre = (F.col("results") + 1) / 2
    sizes = pairs.groupBy(key).agg(F.sum("n").alias("results"))
    placed = pairs.join(ranks(x), [key, x]).join(ranks(y), [key, y]).join(sizes, key)
    dx, dy = F.col(f"rank_{x}") - centre, F.col(f"rank_{y}") - centre
    sums = placed.groupBy(key, "results").agg(
        F.sum(F.col("n") * dx * dy).alias("xy"), F.sum(F.col("n") * dx * dx).alias("xx"), F.sum(F.col("n") * dy * dy).alias("yy")
    )
    return sums.select(
        key, "results", F.try_divide(F.col("xy"), F.sqrt(F.col("xx")) * F.sqrt(F.col("yy"))).alias("rank_correlation")
    )


def head_to_head(facts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Record of each given pair (year, driverId, rivalId) in the races both finished.

    Each side is cut to the drivers of the pairs and to its best place per race before the join, so the work is
    one row per pair and race, never all pairs of a race.
    """

    def best(name: str, place: str) -> DataFrame:
        named = facts.filter("position IS NOT NULL").withColumnRenamed("driverId", name)
        return (
            named.join(pairs.select("year", name).distinct(), ["year", name], "left_semi")
            .groupBy("year", "raceId", name)
            .agg(F.min("position").alias(place))
        )

    met = (
        best("driverId", "place")
        .join(pairs, ["year", "driverId"])
        .join(best("rivalId", "rival_place"), ["year", "raceId", "rivalId"])
    )
    return met.groupBy("year", "driverId", "rivalId").agg(
        F.count(F.lit(1)).alias("races"),
        F.count_if(F.col("place") < F.col("rival_place")).alias("ahead"),
        F.count_if(F.col("place") > F.col("rival_place")).alias("behind"),
    )


def against_leader(seasons: DataFrame) -> DataFrame:
    """Pairs of every driver with the leader of the season, found as a maximum in the order of the standings."""
    order = F.struct("total_points", "total_wins", "total_podiums", -F.col("driverId"))
    leaders = seasons.groupBy("year").agg(F.max_by("driverId", order).alias("rivalId"))
    return seasons.select("year", "driverId").join(leaders, "year").filter("driverId <> rivalId")


def season_trend(seasons: DataFrame) -> DataFrame:
    """Change of points and win rate against the driver's season before; a driver has one row per year."""
    career = Window.partitionBy("driverId").orderBy("year")
    return seasons.select(
        "driverId", "year", "total_points",
        (F.col("total_points") - F.lag("total_points").over(career)).alias("points_change"),
        (F.col("win_rate") - F.lag("win_rate").over(career)).alias("win_rate_change"),
    )


def standings_evolution(facts: DataFrame, races: DataFrame) -> DataFrame:
    """Points of each driver after each round. Rounds are summed first; a window holds one season of one driver."""
    rounds = facts.join(races.select("raceId", "round"), "raceId").groupBy("year", "driverId", "round").agg(
        F.sum("points").alias("points")
    )
    so_far = Window.partitionBy("year", "driverId").orderBy("round").rowsBetween(Window.unboundedPreceding, 0)
    return rounds.withColumn("points_so_far", F.sum("points").over(so_far))


def contribution(partials: DataFrame) -> DataFrame:
    """A driver's share of the team's points in a season; team totals are joined, since a team may have very many
    drivers and a window would hold them all in one task."""
    team = partials.groupBy("constructorId", "year").agg(F.sum("total_points").alias("team_points"))
    return (
        partials.select("constructorId", "driverId", "year", "total_points")
        .join(team, ["constructorId", "year"])
        .withColumn("contribution", M.ratio(F.col("total_points"), F.col("team_points")))
    )


def histogram(df: DataFrame, value: str, width: int, *by: str) -> DataFrame:
    """Rows per bin of ``width``; ``bin`` is its lower bound."""
    return df.groupBy(*by, (F.floor(F.col(value) / width) * width).alias("bin")).agg(F.count(F.lit(1)).alias("rows"))


def eliminated(facts: DataFrame, races: DataFrame, after_round: int, max_points_per_round: float) -> DataFrame:
    """Who can no longer win: the gap to the leader after a round exceeds all points still to be had."""
    joined = facts.join(races.select("raceId", "round"), "raceId")
    rounds = races.groupBy("year").agg(F.count_distinct(F.when(F.col("round") > after_round, F.col("round"))).alias("left"))
    points = joined.filter(F.col("round") <= after_round).groupBy("year", "driverId").agg(
        F.sum("points").alias("points")
    )
    leader = points.groupBy("year").agg(F.max("points").alias("leader_points"))
    gap = F.col("leader_points") - F.col("points")
    return (
        points.join(leader, "year")
        .join(rounds, "year")
        .select(
            "year", "driverId", "points", gap.alias("gap"), F.col("left").alias("rounds_left"),
            (gap > F.col("left") * max_points_per_round).alias("eliminated"),
        )
    )


def still_possible(
    facts: DataFrame, races: DataFrame, after_round: int, table: list[float], races_per_round: int = 1
) -> DataFrame:
    """Who can still win when the points to come are shared: the driver wins all that is left, and the rest must fit.

    ``table`` are the points of the places of one race, best first. If the driver wins every race left, their rivals take the
    other places between them, one each a race. None may pass the driver's final points, so each has a room (these minus own
    points), and m rivals cannot take more than the m best other places of all races. The places fit, in shares of races,
    exactly if for every m the m best places and the rooms of all but the m roomiest rivals hold all points there are
    to share. So a driver who fails cannot win, whatever happens; whoever is out by the gap alone also fails.

    Per season this needs the sum of points and the lowest few points only, as many as places score. Level points
    still win. Without races left the leader, or those level, are left.
    """
    joined = facts.join(races.select("raceId", "round"), "raceId")
    rounds = races.groupBy("year").agg(F.count_distinct(F.when(F.col("round") > after_round, F.col("round"))).alias("left"))
    points = joined.filter(F.col("round") <= after_round).groupBy("year", "driverId").agg(F.sum("points").alias("points"))
    others = [float(v) for v in table[1:]]
    numbered = row_numbers(
        points.filter(F.col("points").isNotNull()), ["year"], [F.asc("points"), F.asc("driverId")], "_n", [F.floor("points")]
    )
    season = numbered.groupBy("year").agg(
        F.count(F.lit(1)).alias("_drivers"), F.sum("points").alias("_sum"), F.max("points").alias("_most"),
        F.array_sort(F.collect_list(F.when(F.col("_n") <= len(others) + 1, F.col("points")))).alias("_lowest"),  # a few
    )
    left = F.col("rounds_left") * races_per_round
    final, rivals = F.col("points") + left * float(table[0]), F.col("_drivers") - 1

    def fits(m: int):
        """Whether the rooms of all but the m roomiest rivals and the m best places hold all shared points."""
        taken = F.least(F.lit(m).cast("long"), rivals)
        own = (F.col("_n") <= taken).cast("int")  # the driver may be among the lowest
        lowest = F.aggregate(F.slice("_lowest", F.lit(1), (taken + own).cast("int")), F.lit(0.0), lambda a, x: a + x)
        room = (rivals - taken) * final - (F.col("_sum") - F.col("points") - (lowest - own * F.col("points")))
        # Fewer rivals than places leave the last places empty.
        shared = F.aggregate(F.slice(places, F.lit(1), rivals.cast("int")), F.lit(0.0), lambda a, x: a + x)
        best = F.aggregate(F.slice(places, F.lit(1), taken.cast("int")), F.lit(0.0), lambda a, x: a + x)
        return left * best + room >= left * shared

    places = F.array(*[F.lit(v) for v in others]) if others else F.array().cast("array<double>")
    possible = F.col("_most") <= final
    for m in range(len(others) + 1):
        possible = possible & fits(m)
    return (
        numbered.join(season, "year").join(rounds.withColumnRenamed("left", "rounds_left"), "year")
        .select("year", "driverId", "points", "rounds_left", final.alias("best_final"), possible.alias("possible"))
    )


def lap_progression(laps: DataFrame, window_laps: int = 3) -> DataFrame:
    """Mean time per race and lap number, smoothed over the last laps; long races are smoothed in blocks."""
    per_lap = laps.groupBy("raceId", "lap").agg(F.avg("milliseconds").alias("average"))
    return framed(
        per_lap, ["raceId"], [F.asc("lap")], window_laps - 1, 0, {"smoothed": F.avg("average")},
        splits=[F.floor(F.col("lap") / 1000)],
    )


def gains_by_stops(qualifying_vs_race: DataFrame, stops: DataFrame) -> DataFrame:
    """Places won between grid and finish by number of stops; no recorded stop counts as 0."""
    made = stops.groupBy("raceId", "driverId").agg(F.count(F.lit(1)).alias("total_pit_stops"))
    return (
        qualifying_vs_race.join(made, ["raceId", "driverId"], "left")
        .na.fill(0, ["total_pit_stops"])
        .groupBy("total_pit_stops")
        .agg(
            F.count(F.lit(1)).alias("results"), F.count("position_change").alias("finished"),
            F.avg("position_change").alias("average_change"),
        )
    )
