"""Analytical reads in set form: the entity argument of each getter becomes an optional filter, so
one plan serves one player / team / day or all of them.

Scale notes
* Dimension joins (teams, players) are left to the planner: AQE broadcasts a side only when its
  measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a shuffle join.
* Per-player trends use positions from ``positions_from_end`` and mergeable aggregates
  (``regr_slope``, sums), so no player's history is gathered into one task.
* Per-(day, position) min/max for ownership is a grouped aggregate joined back (map-side combine)
  rather than a window over the whole group.
* The salary x game join of the slate is an equi join on (team, day) after exploding each game into
  its two sides: a disjunctive ON would be planned as a nested-loop join.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtline.session import cut_lineage

from courtline.functions.exprs import coalesce0
from courtline.operators.frames import positions_from_end, season_chunk
from courtline.operators.storage import write_bucketed

LOG_VIEW = [("player_id", "player_id"), ("game_id", "game_id"), ("game_date", "game_date"),
            ("minutes", "minutes"), ("points", "points"), ("rebounds", "rebounds_total"), ("assists", "assists"),
            ("steals", "steals"), ("blocks", "blocks"), ("turnovers", "turnovers"),
            ("field_goals_made", "field_goals_made"), ("field_goals_attempted", "field_goals_attempted"),
            ("three_pointers_made", "three_pointers_made"), ("three_pointers_attempted", "three_pointers_attempted"),
            ("free_throws_made", "free_throws_made"), ("free_throws_attempted", "free_throws_attempted"),
            ("dfs_points_dk", "dfs_points_dk"), ("dfs_points_fd", "dfs_points_fd"),
            ("true_shooting_percentage", "true_shooting_percentage"), ("usage_rate", "usage_rate"),
            ("is_home", "is_home"), ("opponent_team_id", "opponent_team_id"), ("rest_days", "rest_days"),
            ("is_starter", "is_starter")]


def _d(x):
    return F.to_date(F.lit(str(x)))


def filter_optional(df: DataFrame, date_col: str = "game_date", start=None, end=None, **equals) -> DataFrame:
    """FLT-DYN: apply only the predicates that were given (inclusive date range, equalities)."""
    if start is not None:
        df = df.where(F.col(date_col) >= _d(start))
    if end is not None:
        df = df.where(F.col(date_col) <= _d(end))
    for k, v in equals.items():
        if v is None:
            continue
        df = df.where(F.col(k).isin(list(v))) if isinstance(v, (list, tuple, set)) else df.where(F.col(k) == v)
    return df


def player_game_logs(logs: DataFrame, player_id=None, start=None, end=None, limit: int | None = None) -> DataFrame:
    """AN-LOGS: the 24-column log view, newest first (date, then game, then player); ``limit`` keeps the
    newest n per player (``row_number() <= n``, planned as a WindowGroupLimit that also trims map-side)."""
    df = filter_optional(logs, start=start, end=end, player_id=player_id)
    if "is_starter" not in df.columns:
        df = df.withColumn("is_starter", F.lit(None).cast("boolean"))
    view = df.select(*[F.col(src).alias(dst) for dst, src in LOG_VIEW])
    if limit:
        w = Window.partitionBy("player_id").orderBy(F.col("game_date").desc(), F.col("game_id").desc())
        view = view.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit).drop("_rn")
    return view.orderBy(F.col("game_date").desc(), F.col("game_id").desc(), "player_id")


def games_for_date(games: DataFrame, teams: DataFrame, day=None) -> DataFrame:
    """AN-GAMES: games with both team abbreviations (left joins, NULL when the team is unknown)."""
    g = games if day is None else games.where(F.col("game_date") == _d(day))
    ht = teams.select(F.col("team_id").alias("home_team_id"), F.col("abbreviation").alias("home_team_abbr"))
    at = teams.select(F.col("team_id").alias("away_team_id"), F.col("abbreviation").alias("away_team_abbr"))
    for c, t in (("home_score", "int"), ("away_score", "int"), ("game_status", "string")):
        if c not in g.columns:
            g = g.withColumn(c, F.lit(None).cast(t))
    return (g.join(ht, "home_team_id", "left").join(at, "away_team_id", "left")
            .select("game_id", "game_date", "home_team_id", "away_team_id", "home_team_abbr", "away_team_abbr",
                    "home_score", "away_score", "game_status", "total_line", "home_spread", "away_spread"))


def team_sides(games: DataFrame) -> DataFrame:
    """Each game as two rows (one per team) with the side's flags: the equi-join form of
    ``home_team_id = team OR away_team_id = team``."""
    side = F.explode(F.array(
        F.struct(F.col("home_team_id").alias("team_id"), F.lit(True).alias("is_home"),
                 F.col("home_spread").alias("spread")),
        F.struct(F.col("away_team_id").alias("team_id"), F.lit(False).alias("is_home"),
                 F.col("away_spread").alias("spread"))))
    return games.select("game_id", "game_date", "total_line", side.alias("s")).select(
        "game_id", "game_date", "total_line", "s.team_id", "s.is_home", "s.spread")


def dfs_slate(salaries: DataFrame, players: DataFrame, teams: DataFrame, games: DataFrame, day=None,
              platform: str = "DraftKings") -> DataFrame:
    """AN-SLATE: available salaries of a platform with player, team and that day's game of the team;
    ``spread`` is the player's side; one row per (salary, game) match as in SQL."""
    g = games if day is None else games.where(F.col("game_date") == _d(day))
    return (_offers(salaries, players, teams, day, platform).join(team_sides(g), ["team_id", "game_date"])
            .select("game_date", "player_id", "player_name", "team_id", "team_abbr", "position", "salary",
                    "game_id", "total_line", "spread", "is_home"))


def _offers(salaries: DataFrame, players: DataFrame, teams: DataFrame, day, platform: str) -> DataFrame:
    """Available salaries of a platform with their player and team."""
    s = salaries.where((F.col("platform") == platform) & F.col("is_available"))
    if day is not None:
        s = s.where(F.col("game_date") == _d(day))
    p = players.select("player_id", F.col("name").alias("player_name"), "team_id")
    t = teams.select("team_id", F.col("abbreviation").alias("team_abbr"))
    return s.join(p, "player_id").join(t, "team_id")


def slate_ownership(salaries: DataFrame, players: DataFrame, teams: DataFrame, games: DataFrame, day=None,
                    platform: str = "DraftKings") -> DataFrame:
    """AN-OWN of the whole slate, a row for each salary with ``n_games``, the slate's rows that it stands for.

    What AN-OWN says of a slate's row doesn't depend on its game, and games of the day change no minimum or maximum. So
    salaries are projected before they meet the games, and what moves grows with salaries, not with salaries times
    games; ``per_game`` writes the rows out last, without an exchange."""
    g = games if day is None else games.where(F.col("game_date") == _d(day))
    sides = team_sides(g).groupBy("team_id", "game_date").agg(F.count(F.lit(1)).alias("n_games"))
    offers = _offers(salaries, players, teams, day, platform).join(sides, ["team_id", "game_date"])
    return ownership_projections(offers, carry=["n_games"])


def per_game(rows: DataFrame, count: str = "n_games") -> DataFrame:
    """Each row as often as its ``count`` says."""
    again = F.explode(F.array_repeat(F.lit(True), F.col(count).cast("int")))
    return rows.withColumn("_again", again).drop("_again", count)


def ownership_projections(slate: DataFrame, keys: Sequence[str] = ("game_date",), carry: Sequence[str] = ()) -> DataFrame:
    """AN-OWN: 5 + 20 * (salary - min) / (max - min) inside each (slate, position); 15.0 when all
    salaries of the position are equal; NULL position gives NULL. ``carry`` names columns that are passed on."""
    g = [*keys, "position"]
    mm = (slate.where(F.col("position").isNotNull()).groupBy(*g)
          .agg(F.min("salary").alias("_lo"), F.max("salary").alias("_hi")))
    j = slate.join(mm, g, "left")
    own = (F.when(F.col("_hi") > F.col("_lo"),
                  5 + (F.col("salary") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * 20)
           .when(F.col("_hi").isNotNull(), F.lit(15.0)))
    return j.select(*keys, "player_id", "player_name", "salary", own.alias("ownership_projection"), *carry)


def player_info(players: DataFrame, teams: DataFrame, player_id=None) -> DataFrame:
    """AN-PLAYER: player with the team abbreviation (left join)."""
    p = filter_optional(players, player_id=player_id)
    t = teams.select("team_id", F.col("abbreviation").alias("team_abbr"))
    return p.join(t, "team_id", "left").select("player_id", "name", "position", "team_id", "team_abbr", "is_active")


def team_vs_position(logs: DataFrame, players: DataFrame, start=None, end=None, team_id=None,
                     position=None) -> DataFrame:
    """AN-VSPOS in set form: per (opponent team, position) the average points, rebounds, assists
    and DraftKings points allowed (NULL average -> 0) and the number of logs."""
    l = filter_optional(logs, start=start, end=end, opponent_team_id=team_id)
    p = filter_optional(players.select("player_id", "position"), position=position)
    j = l.join(p, "player_id")
    return (j.groupBy(F.col("opponent_team_id").alias("team_id"), "position")
            .agg(F.coalesce(F.avg("points"), F.lit(0.0)).alias("avg_points_allowed"),
                 F.coalesce(F.avg("rebounds_total"), F.lit(0.0)).alias("avg_rebounds_allowed"),
                 F.coalesce(F.avg("assists"), F.lit(0.0)).alias("avg_assists_allowed"),
                 F.coalesce(F.avg("dfs_points_dk"), F.lit(0.0)).alias("avg_dfs_allowed"),
                 F.count(F.lit(1)).alias("games_sample_size")))


def recent_trends(logs: DataFrame, as_of, days: int = 30, player_id=None) -> DataFrame:
    """AN-TREND in set form: per player, logs of [``as_of - days``, ``as_of``]: count, means (NULL as 0),
    least-squares slopes over newest-first positions (0 when fewer than 3 games; positive = falling)
    and consistency 1/(1 + population std of DraftKings points) (1.0 for a single game)."""
    cutoff = F.date_sub(_d(as_of), int(days))
    l = filter_optional(logs, player_id=player_id).where(F.col("game_date").between(cutoff, _d(as_of)))
    l = l.select("player_id", "game_date", "game_id", coalesce0("dfs_points_dk").cast("double").alias("y_dfs"),
                 coalesce0("minutes").cast("double").alias("y_min"), coalesce0("points").cast("double").alias("y_pts"))
    l = positions_from_end(l, ["player_id"], ["game_date", "game_id"], season_chunk("game_date"), alias="x")
    x = F.col("x").cast("double")
    n = F.count(F.lit(1))
    agg = l.groupBy("player_id").agg(
        n.alias("games_played"), F.avg("y_dfs").alias("avg_dfs_points"), F.avg("y_min").alias("avg_minutes"),
        F.avg("y_pts").alias("avg_points"),
        F.regr_slope("y_dfs", x).alias("_s_dfs"), F.regr_slope("y_min", x).alias("_s_min"),
        F.regr_slope("y_pts", x).alias("_s_pts"), F.stddev_pop("y_dfs").alias("_sd"))
    three = F.col("games_played") >= 3
    return agg.select(
        "player_id", "games_played", "avg_dfs_points", "avg_minutes", "avg_points",
        F.when(three, F.col("_s_dfs")).otherwise(F.lit(0.0)).alias("dfs_trend"),
        F.when(three, F.col("_s_min")).otherwise(F.lit(0.0)).alias("minutes_trend"),
        F.when(three, F.col("_s_pts")).otherwise(F.lit(0.0)).alias("points_trend"),
        F.when(F.col("games_played") > 1, 1.0 / (1.0 + F.col("_sd"))).otherwise(F.lit(1.0)).alias("consistency"))


def injury_report(injuries: DataFrame, players: DataFrame, day=None, start=None, end=None) -> DataFrame:
    """AN-INJ: injuries with injury_date in [d-7, d] for a report day d, newest first, with the player
    name (left join). Without ``day``: the report of every day in [start, end] (or of every day an
    injury is reported on) - each injury exploded over the 8 report days it appears in."""
    p = players.select("player_id", F.col("name").alias("player_name"))
    inj = injuries.select("player_id", "injury_date", "status", "description", "body_part", "games_missed")
    if day is not None:
        d = _d(day)
        rep = inj.where(F.col("injury_date").between(F.date_sub(d, 7), d)).withColumn("report_date", d)
    else:
        rep = inj.withColumn("report_date", F.explode(F.sequence(F.col("injury_date"), F.date_add("injury_date", 7))))
        if start is not None:
            rep = rep.where(F.col("report_date") >= _d(start))
        if end is not None:
            rep = rep.where(F.col("report_date") <= _d(end))
    rep = rep.join(p, "player_id", "left").select("report_date", "player_id", "player_name", "injury_date",
                                                  "status", "description", "body_part", "games_missed")
    return rep.orderBy("report_date", F.col("injury_date").desc(), "player_id")


# Players of a block: a sixteenth of the list within these bounds, and no more than fit so many cells of a table of
# players and dates. Two blocks are paired in one task.
CORR_BLOCK, CORR_CELLS = (64, 768), 2_000_000


def _pair_blocks(nearly: float = 1e-6):
    """The function that correlates two blocks of players, rows of one series each: lists of days with their mean, count and
    squares around the mean (``day``, ``mean``, ``n``, ``m2``; the last two NULL where all are 1 or 0). It holds all it needs, so executors load nothing of this package.

    Sums over the shared dates of all pairs are products of two tables of players and dates. Where a side varies so
    little on them that a difference of sums could lose digits, its moments are taken again around the pair's own means,
    and a side is constant if it has one value."""
    def correlate(key, table):
        import numpy as np
        import pyarrow as pa

        first, second = (k.as_py() for k in key)
        table = table.combine_chunks()
        block, ids = table["_block"].to_numpy(), table["player_id"].combine_chunks()

        def lists(name):
            cells = table[name].combine_chunks()
            return cells.chunk(0) if isinstance(cells, pa.ChunkedArray) else cells

        cells = lists("day")
        sizes = cells.value_lengths().to_numpy()
        owner, begins = np.repeat(np.arange(len(cells)), sizes), np.concatenate([[0], np.cumsum(sizes)])
        day, mean = cells.flatten().to_numpy(), lists("mean").flatten().to_numpy()

        def filled(name, value):
            out, given = np.full(len(day), value), lists(name)
            for i in np.nonzero(given.is_valid().to_numpy(zero_copy_only=False))[0]:
                out[begins[i]:begins[i + 1]] = given[i].values.to_numpy()
            return out

        n, m2 = filled("n", 1.0), filled("m2", 0.0)
        axis, place = np.unique(day, return_inverse=True)

        def dense(rows):
            at = np.full(len(cells), -1)
            at[rows] = np.arange(len(rows))
            mine = at[owner] >= 0
            r, d = at[owner[mine]], place[mine]
            C, M, V = (np.zeros((len(rows), len(axis))) for _ in range(3))
            C[r, d], M[r, d], V[r, d] = n[mine], mean[mine], m2[mine]
            held = C > 0
            odd = ~(np.isfinite(M).all(1) & np.isfinite(V).all(1))
            with np.errstate(all="ignore"):
                centre = np.where(odd, 0.0, (C * M).sum(1) / C.sum(1))
            M = np.where(held, M - centre[:, None], 0.0)
            least, most = np.where(held, M, np.inf).min(1), np.where(held, M, -np.inf).max(1)
            fixed = (least == most) & ~(V > 0).any(1)
            S = C * np.nan_to_num(M)
            return C, M, V, S, np.nan_to_num(V) + S * np.nan_to_num(M), fixed, odd

        left = np.nonzero(block == first)[0]
        right = left if first == second else np.nonzero(block == second)[0]
        if not len(left) or not len(right):
            return pa.table({"player_a": ids[:0], "player_b": ids[:0], "correlation": pa.array([], pa.float64())})
        Ca, Ma, Va, Sa, Qa, fixed_a, odd_a = a = dense(left)
        Cb, Mb, Vb, Sb, Qb, fixed_b, odd_b = a if first == second else dense(right)
        with np.errstate(all="ignore"):
            count = Ca @ Cb.T
            sx, sy, qx, qy = Sa @ Cb.T, Ca @ Sb.T, Qa @ Cb.T, Ca @ Qb.T
            vx, vy = qx - sx * sx / count, qy - sy * sy / count
            value = (Sa @ Sb.T - sx * sy / count) / np.sqrt(vx) / np.sqrt(vy)
            known = (count >= 2) & ~fixed_a[:, None] & ~fixed_b[None, :]
            if first == second:                             # each pair once
                count, known = np.triu(count, 1), np.triu(known, 1)
            again = known & ((vx <= nearly * qx) | (vy <= nearly * qy) | odd_a[:, None] | odd_b[None, :] | ~np.isfinite(value))
            for i in np.nonzero(again.any(1))[0]:
                at, js = np.nonzero(Ca[i] > 0)[0], np.nonzero(again[i])[0]
                for j in (js[k:k + 256] for k in range(0, len(js), 256)):
                    cb = Cb[np.ix_(j, at)]
                    w, on = cb * Ca[i, at], cb > 0
                    x, y = np.where(on, Ma[i, at], 0.0), np.where(on, Mb[np.ix_(j, at)], 0.0)
                    mx, my = ((w * v).sum(1, keepdims=True) / w.sum(1, keepdims=True) for v in (x, y))
                    dx, dy = np.where(on, x - mx, 0.0), np.where(on, y - my, 0.0)
                    va, vb = np.where(on, Va[i, at], 0.0), np.where(on, Vb[np.ix_(j, at)], 0.0)
                    xx, yy = (w * dx * dx + cb * va).sum(1), (w * dy * dy + Ca[i, at] * vb).sum(1)
                    differ = [(np.where(on, v, np.inf).min(1) < np.where(on, v, -np.inf).max(1)) | (u > 0).any(1)
                              for v, u in ((x, va), (y, vb))]
                    value[i, j] = (w * dx * dy).sum(1) / np.sqrt(xx) / np.sqrt(yy)
                    known[i, j] = differ[0] & differ[1] & (xx > 0) & (yy > 0)
        r, c = np.nonzero(count > 0)
        out = pa.array(np.clip(value[r, c], -1.0, 1.0), mask=~known[r, c])
        one, other = ids.take(pa.array(left[r])), ids.take(pa.array(right[c]))
        return pa.table({"player_a": pa.concat_arrays([one, other]), "player_b": pa.concat_arrays([other, one]),
                         "correlation": pa.concat_arrays([out, out])})
    return correlate


def correlation_matrix(logs: DataFrame, player_ids: DataFrame, start=None, end=None) -> DataFrame:
    """AN-CORR in long form: Pearson correlation of DraftKings points between every pair of the
    given players over the dates both played (pairwise complete); NULL for fewer than 2 shared
    dates or a constant series. ``player_ids`` is a one-column frame of any length; the result has its
    length squared rows by definition.

    A player's logs of a date are one cell (count, mean, squares around it), a player's cells one row, at most one for
    each date. Players are dealt into blocks and each two blocks meet in one task (``_pair_blocks``), so a series is
    copied once a block, not once a log and partner, and no row is formed for a pair and a date.
    """
    ids = player_ids.select("player_id").distinct()
    l = (filter_optional(logs, start=start, end=end).where(F.col("dfs_points_dk").isNotNull())
         .join(ids, "player_id")
         .select("player_id", "game_date", F.col("dfs_points_dk").cast("double").alias("v")))
    l = cut_lineage(l)
    one = F.col("lo") == F.col("hi")
    cells = l.where(F.col("game_date").isNotNull()).groupBy("player_id", "game_date").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("m"), F.var_pop("v").alias("s"))
    # what is one value is kept as it is; what isn't has squares above zero
    cell = F.struct(F.unix_date("game_date").alias("day"), "n", F.when(one, F.col("lo")).otherwise(F.col("m")).alias("mean"),
                    F.when(one, F.lit(0.0)).otherwise(F.greatest(F.col("s") * F.col("n"), F.lit(1e-300))).alias("m2"))
    series = cells.groupBy("player_id").agg(F.collect_list(cell).alias("series"))
    # lists of plain numbers, which are copied once a block, and none that says nothing
    n, m2 = F.col("series.n"), F.col("series.m2")
    series = cut_lineage(series.select("player_id", F.col("series.day").alias("day"), F.col("series.mean").alias("mean"),
                                       F.when(F.exists(n, lambda x: x != 1), n).alias("n"), F.when(F.exists(m2, lambda x: x != 0), m2).alias("m2")))
    players, days = series.count(), l.select("game_date").distinct().count()
    size = max(1, min(max(players // 16, CORR_BLOCK[0]), CORR_BLOCK[1], CORR_CELLS // max(days, 1)))
    blocks = max(1, -(-players // size))
    dealt = series.withColumn("_block", F.pmod(F.xxhash64("player_id"), F.lit(blocks).cast("long"))) \
        .withColumn("_with", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    kind = l.schema["player_id"].dataType.simpleString()
    off = dealt.groupBy(F.least("_block", "_with").alias("_first"), F.greatest("_block", "_with").alias("_second")) \
        .applyInArrow(_pair_blocks(), f"player_a {kind}, player_b {kind}, correlation double")
    # diagonal: a series with itself is 1 unless it is constant or too short
    d = l.groupBy(F.col("player_id").alias("player_a")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    d = d.select("player_a", F.col("player_a").alias("player_b"),
                 F.when((F.col("n") >= 2) & (F.col("lo") < F.col("hi")), F.lit(1.0)).alias("correlation"))
    return off.unionByName(d)


def wide_series(logs: DataFrame, ids: Sequence[int], value: str = "dfs_points_dk", names: Sequence[str] | None = None,
                start=None, end=None) -> DataFrame:
    """JN-FULL: the players' series side by side, a row for each date on which any of them played and a column for
    each player, NULL where that player has no log; the full outer join of the series on the date.

    The list is declared, so the columns are known while planning and the join is one aggregation (``pivot``), however
    many series there are. A player's second game of a date is in a second row of that date (``game_of_day``), by
    game id. ``names`` are the columns' names, ``player_<id>`` if not given; an id without a log has a NULL column."""
    ids = list(dict.fromkeys(ids))
    names = list(names) if names is not None else [f"player_{i}" for i in ids]
    if len(names) != len(ids):
        raise ValueError("a name for each id")
    l = filter_optional(logs, start=start, end=end).where(F.col("player_id").isin(ids))
    nth = F.row_number().over(Window.partitionBy("player_id", "game_date").orderBy("game_id"))
    l = l.select("game_date", "player_id", nth.cast("long").alias("game_of_day"), value)
    wide = l.groupBy("game_date", "game_of_day").pivot("player_id", ids).agg(F.first(value))
    return wide.toDF("game_date", "game_of_day", *names)


def top_players_by(logs: DataFrame, k: int, value: str = "dfs_points_dk") -> DataFrame:
    """The ``k`` players with the highest total ``value`` (ties by id): a top-k report."""
    return (logs.groupBy("player_id").agg(F.sum(coalesce0(value)).alias("_t"))
            .orderBy(F.col("_t").desc(), "player_id").limit(k).select("player_id"))


def period_chunks(df: DataFrame, date_col: str, start, end, chunk_size: int) -> DataFrame:
    """AN-CHUNK: label rows of [start, end] with consecutive periods of ``chunk_size + 1`` days
    (inclusive ends; the last one is cut at ``end``)."""
    s, e = _d(start), _d(end)
    cid = F.floor(F.datediff(F.col(date_col), s) / (chunk_size + 1)).cast("long")
    cs = F.date_add(s, (cid * (chunk_size + 1)).cast("int"))
    return (df.where(F.col(date_col).between(s, e))
            .withColumns({"chunk_id": cid, "chunk_start": cs, "chunk_end": F.least(F.date_add(cs, chunk_size), e)}))


def training_data(features: DataFrame, logs: DataFrame, salaries: DataFrame, start=None, end=None,
                  min_salary: int = 3000) -> DataFrame:
    """AN-TRAIN: features joined to the actual outcome (log on the same day) and the DraftKings
    salary of the day (salary >= ``min_salary``); value = actual DraftKings points per 1000 salary,
    0 when the salary is not positive. The salary's position replaces the feature position."""
    f = filter_optional(features, date_col="target_date", start=start, end=end)
    s = (salaries.where((F.col("platform") == "DraftKings") & (F.col("salary") >= min_salary))
         .select("player_id", F.col("game_date").alias("target_date"), "salary",
                 F.col("position").alias("_sal_position")))
    return _with_outcomes(f.join(s, ["player_id", "target_date"]), logs)


def training_from_store(spark, path: str, logs: DataFrame, salaries: DataFrame, version: str = "v1", start=None, end=None,
                        min_salary: int = 3000) -> DataFrame:
    """AN-TRAIN over the feature store: the stored features of one version (its partitions and the range's
    seasons only), then ``training_data``."""
    from courtline.plans.exports import read_features
    stored = read_features(spark, path, version=version, start=start, end=end)
    return training_data(stored.drop("feature_set_version", "season", "created_at"), logs, salaries, start, end, min_salary)


def training_from_buckets(spark, features: DataFrame, logs: DataFrame, salaries: DataFrame, root: str, buckets: int,
                          min_salary: int = 3000) -> DataFrame:
    """JN-TRAIN over tables that are kept bucketed by (player, date), as a store that is joined again and again would
    be: the tables are written once under ``root``; each later training read exchanges the logs once, and neither
    features nor salaries."""
    name = re.sub(r"\W", "_", root.rsplit("/", 1)[-1])
    keys = ["player_id", "target_date"]
    offers = salaries.where((F.col("platform") == "DraftKings") & (F.col("salary") >= min_salary)) \
        .select("player_id", F.col("game_date").alias("target_date"), "salary", F.col("position").alias("_sal_position"))
    write_bucketed(features, f"{name}_features", f"{root}/features", keys, buckets)
    write_bucketed(offers, f"{name}_salaries", f"{root}/salaries", keys, buckets)
    f, s = spark.read.table(f"{name}_features"), spark.read.table(f"{name}_salaries")
    return _with_outcomes(f.join(s, keys), logs)


def _with_outcomes(priced: DataFrame, logs: DataFrame) -> DataFrame:
    """Priced feature rows with the outcome of the day; the salary's position replaces the feature position."""
    l = logs.select("player_id", F.col("game_date").alias("target_date"),
                    F.col("dfs_points_dk").alias("actual_dfs_points"), F.col("minutes").alias("actual_minutes"),
                    F.col("points").alias("actual_points"), F.col("rebounds_total").alias("actual_rebounds"),
                    F.col("assists").alias("actual_assists"))
    j = priced.join(l, ["player_id", "target_date"])
    j = j.withColumn("position", F.col("_sal_position")).drop("_sal_position")
    return j.withColumn("value", F.when(F.col("salary") > 0, F.col("actual_dfs_points") / (F.col("salary") / 1000))
                        .otherwise(F.lit(0.0)))


def with_fanduel(training: DataFrame, salaries: DataFrame) -> DataFrame:
    """Training rows with both platforms' salaries of the day (``salary_dk``, ``salary_fd``; NULL without one)."""
    fd = (salaries.where(F.col("platform") == "FanDuel").groupBy("player_id", F.col("game_date").alias("target_date"))
          .agg(F.max("salary").alias("salary_fd")))
    return training.withColumnRenamed("salary", "salary_dk").join(fd, ["player_id", "target_date"], "left")


def export_filter(training: DataFrame, min_salary: int = 0, min_minutes: float = 0) -> DataFrame:
    """AN-EXPORT thresholds: either platform's salary reaches ``min_salary`` and the minutes ``min_minutes``;
    0 turns a filter off."""
    keep = F.lit(True)
    if min_salary > 0:
        keep = keep & ((F.col("salary_dk") >= min_salary) | (F.col("salary_fd") >= min_salary))
    if min_minutes > 0:
        keep = keep & (F.col("actual_minutes") >= min_minutes)
    return training.where(keep)


def export_training(training: DataFrame, path: str, min_salary: int = 0, min_minutes: float = 0) -> None:
    """AN-EXPORT rows: what ``export_filter`` keeps, as parquet by season."""
    from courtline.functions.exprs import season_label
    from courtline.operators.sinks import write_partitioned
    kept = export_filter(training, min_salary, min_minutes).withColumn("season", season_label("target_date"))
    write_partitioned(kept, path, ["season"], replace_all=True)


def export_summary(training: DataFrame, min_salary: int = 0, min_minutes: float = 0,
                   target: str = "actual_dfs_points") -> DataFrame:
    """AN-EXPORT: apply the export thresholds (0 turns a filter off) and summarise: rows kept and
    removed, date range, unique players, target mean and sample std. One aggregate over the input."""
    keep = F.lit(True)
    if min_salary > 0:
        keep = keep & (F.col("salary") >= min_salary)
    if min_minutes > 0:
        keep = keep & (F.col("actual_minutes") >= min_minutes)
    k = F.coalesce(keep, F.lit(False))
    return training.agg(
        F.count_if(k).alias("records"), F.count_if(~k).alias("filtered_out"),
        F.min(F.when(k, F.col("target_date"))).alias("first_date"),
        F.max(F.when(k, F.col("target_date"))).alias("last_date"),
        F.count_distinct(F.when(k, F.col("player_id"))).alias("unique_players"),
        F.avg(F.when(k, F.col(target))).alias("target_mean"),
        F.stddev_samp(F.when(k, F.col(target))).alias("target_std"))
