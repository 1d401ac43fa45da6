"""A cross-section of registered queries against their DuckDB SQL at sf0.001."""
import math

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
NAMES = ["interval_join", "dedup", "speed_kmh", "min_points", "kinematic_12", "seq_build", "quality_report",
         "strat_split", "class_report", "fusion_join", "embed_text", "spatial_join", "scene_context",
         "trip_summary", "describe", "prompt", "append_resume", "label_scan", "geojson_collection"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 4) + 0.0)
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF_SMALL)
    cols = df.columns
    a = sorted(tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
    res = con.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    b = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert sorted(cols) == sorted(ocols)
    assert a == b


def test_every_sql_key_is_a_query():
    assert set(oracle_sql()) <= set(queries())
