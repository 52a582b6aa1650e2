"""Registered queries with their DuckDB statements."""
from __future__ import annotations

from creditecho.catalog import features, loans, models, reviews, scoring, search

PARTS = (loans.R, features.R, scoring.R, reviews.R, search.R, models.R)


def all_runs() -> dict:
    return {name: run for part in PARTS for name, run in part.runs.items()}


def all_sql() -> dict[str, str]:
    return {name: text for part in PARTS for name, text in part.sql.items()}
