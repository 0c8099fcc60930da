"""Collects the query modules so importing one name registers everything."""

from __future__ import annotations

import functools

from hirelens.plans import catalog


def _load():
    # each module registers its queries into catalog.QUERIES / catalog.ORACLE on import
    from hirelens.plans import q_crawl, q_extra, q_ingest, q_io, q_ml, q_ops, q_stats, q_stream  # noqa: F401


def _pinned(fn):
    """Timestamps in the test data are zone-less; event-time windows and
    epoch conversions must read them as UTC whatever session calls us."""
    @functools.wraps(fn)
    def run(spark, sf_dir):
        if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    return run


def queries():
    _load()
    return {k: _pinned(v) for k, v in catalog.QUERIES.items()}


def oracle_sql():
    _load()
    return {k: v for k, v in catalog.ORACLE.items() if k in catalog.QUERIES}
