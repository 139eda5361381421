"""Collects the registered queries of all plan modules."""

from __future__ import annotations


def _load():
    # Importing the modules registers their queries.
    from strata.plans import queries  # noqa: F401
    from strata.plans import queries_dumps  # noqa: F401
    from strata.plans import queries_elt  # noqa: F401
    from strata.plans import queries_ops  # noqa: F401
    from strata.plans import queries_raw  # noqa: F401
    from strata.plans import queries_stream  # noqa: F401
    return queries.QUERIES, queries.ORACLE


def all_queries():
    return dict(_load()[0])


def all_oracle_sql():
    return dict(_load()[1])
