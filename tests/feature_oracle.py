"""Plain-Python point-in-time features, written from the rules (one player and one day at a time),
to check the set-based Spark plan on small hand-made data."""

from __future__ import annotations

import datetime as dt
import math
from statistics import mean

import numpy as np


def _z(x):
    return 0 if x is None else x


def _std(xs, ddof):
    if len(xs) - ddof <= 0:
        return None
    return float(np.std(np.asarray(xs, dtype=float), ddof=ddof))


def _slope(ys):
    if len(ys) < 2:
        return None
    return float(np.polyfit(np.arange(len(ys)), np.asarray(ys, dtype=float), 1)[0])


def _season_start(t):
    return dt.date(t.year if t.month >= 10 else t.year - 1, 10, 1)


def features(logs, players, games, injuries, salaries, start, end):
    games_by_id = {g["game_id"]: g for g in games}
    out = {}
    day = start
    while day <= end:
        for p in players:
            if not p["is_active"]:
                continue
            pid = p["player_id"]
            mine = sorted([l for l in logs if l["player_id"] == pid], key=lambda l: (l["game_date"], l["game_id"]))
            hist = [l for l in mine if l["game_date"] < day][::-1][:50]
            if len(hist) < 5:
                continue
            f = {"position": p["position"], "team_id": p["team_id"], "is_active": p["is_active"]}
            for n in (5, 10, 15, 30):
                if len(hist) < n:
                    continue
                w = hist[:n]
                for name, src in (("points", "points"), ("rebounds", "rebounds_total"), ("assists", "assists"),
                                  ("steals", "steals"), ("blocks", "blocks"), ("turnovers", "turnovers"),
                                  ("minutes", "minutes"), ("dfs_points", "dfs_points_dk"), ("usage_rate", "usage_rate"),
                                  ("true_shooting", "true_shooting_percentage")):
                    f[f"avg_{name}_L{n}"] = mean(_z(l[src]) for l in w)
                for name, m, a in (("fg", "field_goals_made", "field_goals_attempted"),
                                   ("3p", "three_pointers_made", "three_pointers_attempted"),
                                   ("ft", "free_throws_made", "free_throws_attempted")):
                    sa = sum(_z(l[a]) for l in w)
                    f[f"avg_{name}_pct_L{n}"] = sum(_z(l[m]) for l in w) / sa if sa else 0.0
                for name, src in (("points", "points"), ("dfs_points", "dfs_points_dk"), ("minutes", "minutes")):
                    f[f"std_{name}_L{n}"] = _std([_z(l[src]) for l in w], 1)
                f[f"games_played_L{n}"] = n
            f["last_game_points"] = _z(hist[0]["points"])
            f["last_game_dfs_points"] = _z(hist[0]["dfs_points_dk"])
            f["last_game_minutes"] = _z(hist[0]["minutes"])
            if len(hist) >= 6:
                for name, src in (("points_trend_recent", "points"), ("dfs_trend_recent", "dfs_points_dk")):
                    f[name] = mean(_z(l[src]) for l in hist[:3]) - mean(_z(l[src]) for l in hist[3:6])
            if len(hist) >= 10:
                f["recent_consistency"] = 1.0 / (1.0 + _std([_z(l["dfs_points_dk"]) for l in hist[:10]], 0))
            tm = sum(_z(l["minutes"]) for l in hist[:15])
            if tm > 0:
                pos = sum(_z(l["points"]) + _z(l["rebounds_total"]) + _z(l["assists"]) + _z(l["steals"]) + _z(l["blocks"])
                          for l in hist[:15])
                neg = sum(_z(l["field_goals_attempted"]) - _z(l["field_goals_made"]) + _z(l["free_throws_attempted"])
                          - _z(l["free_throws_made"]) + _z(l["turnovers"]) for l in hist[:15])
                f["per_estimate"] = (pos - neg) / (tm / 48)
            for avg_name, trend_name, src in (("avg_usage_rate", "usage_rate_trend", "usage_rate"),
                                              ("avg_true_shooting", "shooting_trend", "true_shooting_percentage")):
                vals = [l[src] for l in hist[:10] if l[src]]
                if vals:
                    f[avg_name] = mean(vals)
                    f[trend_name] = _slope(vals)
            # opponent: the player's game on the day (first by game id)
            today = sorted([l for l in mine if l["game_date"] == day], key=lambda l: l["game_id"])
            if today:
                g = games_by_id[today[0]["game_id"]]
                home = p["team_id"] == g["home_team_id"]
                opp = g["away_team_id"] if home else g["home_team_id"]
                f["opponent_team_id"], f["is_home_game"] = opp, home
                vs = [l for l in mine if l["opponent_team_id"] == opp and l["game_date"] < day][::-1][:5]
                if vs:
                    f["avg_points_vs_opponent"] = mean(_z(l["points"]) for l in vs)
                    f["avg_dfs_vs_opponent"] = mean(_z(l["dfs_points_dk"]) for l in vs)
                    f["games_vs_opponent"] = len(vs)
            inj = [i for i in injuries if i["player_id"] == pid and day - dt.timedelta(days=30) <= i["injury_date"] < day]
            f["recent_injury_count"] = len(inj)
            f["has_recent_injury"] = len(inj) > 0
            f["days_since_injury"] = (day - max(i["injury_date"] for i in inj)).days if inj else 999
            f["rest_days"] = (day - hist[0]["game_date"]).days - 1
            f["is_back_to_back"] = f["rest_days"] == 0
            rl = [l["rest_days"] for l in hist[:10] if l["rest_days"] is not None]
            if rl:
                f["avg_rest_days"] = mean(rl)
                f["std_rest_days"] = _std(rl, 0)
            h = [l for l in hist[:20] if l["is_home"]]
            a = [l for l in hist[:20] if not l["is_home"]]
            for side, ls in (("home", h), ("away", a)):
                if ls:
                    f[f"avg_points_{side}"] = mean(_z(l["points"]) for l in ls)
                    f[f"avg_dfs_{side}"] = mean(_z(l["dfs_points_dk"]) for l in ls)
                    f[f"{side}_games_count"] = len(ls)
            if h and a:
                f["home_away_dfs_diff"] = f["avg_dfs_home"] - f["avg_dfs_away"]
            cur = [s for s in salaries if s["player_id"] == pid and s["game_date"] == day and s["platform"] == "DraftKings"]
            if cur:
                f["current_salary_dk"] = cur[0]["salary"]
                logged_days = {l["game_date"] for l in mine}
                past = sorted([s for s in salaries if s["player_id"] == pid and s["platform"] == "DraftKings"
                               and s["game_date"] < day and s["game_date"] in logged_days],
                              key=lambda s: s["game_date"], reverse=True)[:10]
                vals = []
                for s in past:
                    lg = sorted([l for l in mine if l["game_date"] == s["game_date"]], key=lambda l: l["game_id"])[0]
                    if lg["dfs_points_dk"] and s["salary"] > 0:
                        vals.append(lg["dfs_points_dk"] / s["salary"] * 1000)
                if vals:
                    f["avg_value_dk"] = mean(vals)
                    f["std_value_dk"] = _std(vals, 0)
            if len(hist) >= 10:
                ss = _season_start(day)
                sl = [l for l in hist if l["game_date"] >= ss]
                if sl:
                    f["season_avg_points"] = mean(_z(l["points"]) for l in sl)
                    f["season_avg_dfs"] = mean(_z(l["dfs_points_dk"]) for l in sl)
                    f["season_games_played"] = len(sl)
                    if len(sl) >= 20:
                        mid = len(sl) // 2
                        f["seasonal_trend"] = (mean(_z(l["dfs_points_dk"]) for l in sl[:mid])
                                               - mean(_z(l["dfs_points_dk"]) for l in sl[mid:]))
            out[(pid, day)] = f
        day += dt.timedelta(days=1)
    return out


def close(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, bool) or isinstance(b, bool):
        return bool(a) == bool(b)
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)
    return a == b
