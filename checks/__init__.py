"""Queries over the given tables, each with the SQL that must agree with it."""

from . import aggregates, backlog, finished, framing, joins, routing, runs, scans, sinks, streams

MODULES = (scans, framing, routing, backlog, joins, aggregates, sinks, runs, finished, streams)


def all_queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_sql():
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
