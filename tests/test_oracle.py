"""The driver's correctness gate on the smallest scale: Spark query vs its
DuckDB SQL (row count, column names, order-insensitive values)."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SMALL_SF

sys.path.insert(0, os.path.join(ROOT, "tools"))
from oracle_check import TABLES, rows_key  # noqa: E402

CHEAP = ["transcript_ids", "utterances_from_json", "manifest_lookup", "lines_from_text",
         "sentences_from_text", "chunk_transcript", "chunked_json", "parse_labelled",
         "consolidate_literal", "render_chunked", "accuracy_lev", "model_requests", "score_table"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SMALL_SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", CHEAP)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SMALL_SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_key(df.columns, srows) == rows_key(dcols, drows)


def test_every_oracle_has_a_query():
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
