"""Domain frames (teams, players, games, player_game_logs, dfs_salaries, injuries) built from the
driver's TPC-H-like tables.

The same definitions exist twice: as DataFrame code (what the library runs) and as SQL text
(``ORACLE_CTES``) that the DuckDB oracle puts in front of every check. Both use integer arithmetic
only, so they agree row for row.

Scale notes: every frame is a lazy plan. ``player_game_logs`` aggregates lineitem by
(supplier, order) with map-side partial aggregation and sort-merge joins games on the order key
(AQE splits a skewed game partition).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (a parquet file or a directory of parquet files)."""
    from courtline.session import path_exists
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if not path_exists(spark, path) and path_exists(spark, f"{sf_dir.rstrip('/')}/{name}"):
        path = f"{sf_dir.rstrip('/')}/{name}"
    return spark.read.parquet(path)


@dataclass
class Domain:
    """Lazily built domain frames over one driver data directory."""

    spark: SparkSession
    sf_dir: str

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def teams(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return (n.join(r, n.n_regionkey == r.r_regionkey)
                .select(n.n_nationkey.cast("long").alias("team_id"),
                        n.n_name.alias("abbreviation"), n.n_name.alias("name"),
                        r.r_name.alias("conference"), F.lit(None).cast("string").alias("division")))

    @cached_property
    def players(self) -> DataFrame:
        s = self.raw("supplier")
        k = F.col("s_suppkey")
        pos = (F.when(k % 5 == 0, "PG").when(k % 5 == 1, "SG").when(k % 5 == 2, "SF")
               .when(k % 5 == 3, "PF").otherwise("C"))
        return s.select(k.alias("id"), k.alias("player_id"), F.col("s_name").alias("name"),
                        F.col("s_nationkey").cast("long").alias("team_id"), pos.alias("position"),
                        (k % 10 != 9).alias("is_active"))

    @cached_property
    def games(self) -> DataFrame:
        o, c = self.raw("orders"), self.raw("customer")
        ok = F.col("o_orderkey")
        return (o.join(c, o.o_custkey == c.c_custkey)
                .select(ok.alias("game_id"), F.to_date("o_orderdate").alias("game_date"),
                        F.col("c_nationkey").cast("long").alias("home_team_id"),
                        ((F.col("c_nationkey") + 1 + ok % 24) % 25).cast("long").alias("away_team_id"),
                        (200 + ok % 50).cast("double").alias("total_line"),
                        (ok % 25 - 12).cast("double").alias("home_spread"),
                        (12 - ok % 25).cast("double").alias("away_spread")))

    @cached_property
    def player_game_logs(self) -> DataFrame:
        li = (self.raw("lineitem")
              .select("l_orderkey", "l_suppkey", "l_quantity", "l_partkey")
              # partial aggregation runs map-side before the shuffle, so an order with a huge number of
              # lines is combined per task first (no explicit repartition on the order key)
              .groupBy("l_suppkey", "l_orderkey")
              .agg(F.sum("l_quantity").alias("minutes"), F.sum("l_partkey").cast("long").alias("k"))
              .select(F.col("l_suppkey").alias("player_id"), F.col("l_orderkey").alias("game_id"),
                      "minutes", "k"))
        g = self.games.select("game_id", "game_date", "home_team_id", "away_team_id")
        k = F.col("k")

        def m(mult, mod):
            return ((k * mult) % mod).cast("int")

        # Sort-merge join on the game key. Left to itself the planner may broadcast the *logs* (the
        # larger side) and stream the games, which puts all log rows in as many tasks as the games
        # scan has - one per input file.
        return (li.join(g.hint("merge"), "game_id")
                .select("player_id", "game_id", "game_date", "minutes",
                        F.when(k % 17 == 0, F.lit(None)).otherwise(k % 41).cast("int").alias("points"),
                        m(7, 19).alias("field_goals_made"), m(5, 23).alias("field_goals_attempted"),
                        m(3, 7).alias("three_pointers_made"), m(11, 9).alias("three_pointers_attempted"),
                        m(13, 8).alias("free_throws_made"), m(17, 10).alias("free_throws_attempted"),
                        m(41, 6).alias("rebounds_offensive"), m(43, 11).alias("rebounds_defensive"),
                        m(19, 16).alias("rebounds_total"), m(23, 14).alias("assists"),
                        m(29, 5).alias("steals"), m(31, 5).alias("blocks"), m(37, 7).alias("turnovers"),
                        m(47, 6).alias("personal_fouls"),
                        (k % 2 == 0).alias("is_home"),
                        F.when(k % 2 == 0, F.col("away_team_id")).otherwise(F.col("home_team_id"))
                        .alias("opponent_team_id"),
                        # columns the ETL fills in; the driver data has none of them
                        F.lit(None).cast("double").alias("true_shooting_percentage"),
                        F.lit(None).cast("double").alias("effective_field_goal_percentage"),
                        F.lit(None).cast("double").alias("usage_rate"),
                        F.lit(None).cast("double").alias("dfs_points_dk"),
                        F.lit(None).cast("double").alias("dfs_points_fd"),
                        F.lit(None).cast("int").alias("rest_days")))

    @cached_property
    def dfs_salaries(self) -> DataFrame:
        logs = self.player_game_logs
        sk = (logs.groupBy("player_id", "game_date")
              .agg(F.sum(F.col("points").cast("long") * 31 + F.col("game_id")).alias("sk"))
              .where(F.col("sk").isNotNull() & (F.col("sk") % 7 != 0)))
        # two platforms as an explode of a literal array (a generator, not a join)
        plat = F.explode(F.array(F.struct(F.lit("DraftKings").alias("platform"), F.lit(1).alias("f")),
                                 F.struct(F.lit("FanDuel").alias("platform"), F.lit(3).alias("f"))))
        # the listed position is the player's position (the driver data has no separate one)
        pos = self.players.select("player_id", "position")
        return (sk.select("*", plat.alias("p")).join(pos, "player_id", "left")
                .select("player_id", "game_date", F.col("p.platform").alias("platform"),
                        (3000 + (F.col("sk") * F.col("p.f")) % 8500).cast("int").alias("salary"),
                        "position", (F.col("sk") % 20 != 0).alias("is_available")))

    @cached_property
    def injuries(self) -> DataFrame:
        li = (self.raw("lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45))
              .select("l_suppkey", "l_partkey", "l_shipdate", "l_linestatus"))
        p = self.raw("part").select("p_partkey", "p_type")
        return (li.join(p, li.l_partkey == p.p_partkey)
                .select(F.col("l_suppkey").alias("player_id"), F.to_date("l_shipdate").alias("injury_date"),
                        F.when(F.col("l_linestatus") == "O", "Out").otherwise("Questionable").alias("status"),
                        F.lit(None).cast("string").alias("description"),
                        F.col("p_type").alias("body_part"),
                        F.lit(None).cast("date").alias("return_date"),
                        F.lit(None).cast("int").alias("games_missed")))


# --------------------------------------------------------------------------------------------
# The same frames as DuckDB SQL, used as leading CTEs of every oracle query.
ORACLE_CTES = """
teams AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS team_id, n.n_name AS abbreviation, n.n_name AS name,
         r.r_name AS conference, CAST(NULL AS VARCHAR) AS division
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
players AS (
  SELECT s_suppkey AS id, s_suppkey AS player_id, s_name AS name, CAST(s_nationkey AS BIGINT) AS team_id,
         CASE s_suppkey % 5 WHEN 0 THEN 'PG' WHEN 1 THEN 'SG' WHEN 2 THEN 'SF' WHEN 3 THEN 'PF' ELSE 'C' END AS position,
         s_suppkey % 10 <> 9 AS is_active
  FROM supplier),
games AS (
  SELECT o.o_orderkey AS game_id, CAST(o.o_orderdate AS DATE) AS game_date,
         CAST(c.c_nationkey AS BIGINT) AS home_team_id,
         CAST((c.c_nationkey + 1 + o.o_orderkey % 24) % 25 AS BIGINT) AS away_team_id,
         CAST(200 + o.o_orderkey % 50 AS DOUBLE) AS total_line,
         CAST(o.o_orderkey % 25 - 12 AS DOUBLE) AS home_spread,
         CAST(12 - o.o_orderkey % 25 AS DOUBLE) AS away_spread
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
player_game_logs AS (
  SELECT li.player_id, li.game_id, g.game_date, li.minutes,
    CAST(CASE WHEN k % 17 = 0 THEN NULL ELSE k % 41 END AS INTEGER) AS points,
    CAST((k * 7) % 19 AS INTEGER) AS field_goals_made, CAST((k * 5) % 23 AS INTEGER) AS field_goals_attempted,
    CAST((k * 3) % 7 AS INTEGER) AS three_pointers_made, CAST((k * 11) % 9 AS INTEGER) AS three_pointers_attempted,
    CAST((k * 13) % 8 AS INTEGER) AS free_throws_made, CAST((k * 17) % 10 AS INTEGER) AS free_throws_attempted,
    CAST((k * 41) % 6 AS INTEGER) AS rebounds_offensive, CAST((k * 43) % 11 AS INTEGER) AS rebounds_defensive,
    CAST((k * 19) % 16 AS INTEGER) AS rebounds_total, CAST((k * 23) % 14 AS INTEGER) AS assists,
    CAST((k * 29) % 5 AS INTEGER) AS steals, CAST((k * 31) % 5 AS INTEGER) AS blocks,
    CAST((k * 37) % 7 AS INTEGER) AS turnovers, CAST((k * 47) % 6 AS INTEGER) AS personal_fouls,
    k % 2 = 0 AS is_home,
    CASE WHEN k % 2 = 0 THEN g.away_team_id ELSE g.home_team_id END AS opponent_team_id,
    CAST(NULL AS DOUBLE) AS true_shooting_percentage, CAST(NULL AS DOUBLE) AS effective_field_goal_percentage,
    CAST(NULL AS DOUBLE) AS usage_rate, CAST(NULL AS DOUBLE) AS dfs_points_dk, CAST(NULL AS DOUBLE) AS dfs_points_fd,
    CAST(NULL AS INTEGER) AS rest_days
  FROM (SELECT l_suppkey AS player_id, l_orderkey AS game_id, sum(l_quantity) AS minutes,
               CAST(sum(l_partkey) AS BIGINT) AS k
        FROM lineitem GROUP BY l_suppkey, l_orderkey) li
  JOIN games g ON li.game_id = g.game_id),
dfs_salaries AS (
  SELECT x.player_id, game_date, p.platform, CAST(3000 + (sk * p.f) % 8500 AS INTEGER) AS salary,
         pl.position, (sk % 20) <> 0 AS is_available
  FROM (SELECT player_id, game_date, CAST(sum(CAST(points AS BIGINT) * 31 + game_id) AS BIGINT) AS sk
        FROM player_game_logs GROUP BY player_id, game_date) x
  CROSS JOIN (SELECT 'DraftKings' AS platform, 1 AS f UNION ALL SELECT 'FanDuel', 3) p
  LEFT JOIN players pl ON x.player_id = pl.player_id
  WHERE sk IS NOT NULL AND sk % 7 <> 0),
injuries AS (
  SELECT l_suppkey AS player_id, CAST(l_shipdate AS DATE) AS injury_date,
         CASE l_linestatus WHEN 'O' THEN 'Out' ELSE 'Questionable' END AS status,
         CAST(NULL AS VARCHAR) AS description, p.p_type AS body_part,
         CAST(NULL AS DATE) AS return_date, CAST(NULL AS INTEGER) AS games_missed
  FROM lineitem JOIN part p ON l_partkey = p.p_partkey
  WHERE l_returnflag = 'R' AND l_quantity >= 45)
"""
