"""Operators for training-data pipelines; nothing else in the library imports them."""

from . import alignment, backoff, chosen_path, cover_tree, dedup, huffman, importance, licenses, mixing, packing, runs, secrets, sharding

_MODULES = (alignment, backoff, chosen_path, cover_tree, dedup, huffman, importance, licenses, mixing, packing, runs, secrets, sharding)


def queries():
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
