"""Operators for training-data pipelines. Nothing else in the library imports this subpackage."""


def queries():
    from .entries import QUERIES

    return dict(QUERIES)


def oracle_sql():
    from .entries import ORACLE_SQL

    return dict(ORACLE_SQL)
