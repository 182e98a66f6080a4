"""All queries of the library proper with the SQL that states their results."""

from __future__ import annotations

from lexalign.plans.view_queries import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)
