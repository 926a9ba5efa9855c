"""The cleaned domain: adapter frames passed through the full ETL."""

from __future__ import annotations

from courtline.operators.etl import run_full_etl
from courtline.sources.adapter import Domain


def etl_domain(dom: Domain, start=None, end=None):
    """(players, teams, logs) after ETL-RUN as lazy plans."""
    return run_full_etl(dom.players, dom.teams, dom.player_game_logs, start, end)
