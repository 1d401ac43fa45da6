"""Import every query module so that all queries are registered."""

from __future__ import annotations

import importlib

from pyspark.sql import SparkSession

from . import catalog

_MODULES = ["q_trajectory", "q_learning", "q_context", "q_describe", "q_sources", "q_train"]


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"{__package__}.{m}")


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries():
    _load()
    return {k: _wrap(v) for k, v in catalog.QUERIES.items()}


def all_oracle_sql():
    _load()
    return dict(catalog.ORACLE)
