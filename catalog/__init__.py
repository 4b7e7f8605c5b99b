"""Registered queries: each has a Spark form and, where SQL can say it, the equivalent SQL."""

QUERIES = {}
ORACLE = {}


def query(name, sql=None):
    def add(fn):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def load_all():
    from catalog import (anomalies, features, forecasts, learners, resampling, streams, verbs)  # noqa: F401
    return QUERIES, ORACLE
