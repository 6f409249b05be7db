"""The registered queries of this package against their SQL."""

import glob
import os

import duckdb
import pytest
from test_oracles import rows_of

from playqos.llm.queries import ORACLES, QUERIES


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[: -len('.parquet')]} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(ORACLES[name])
    want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want and len(got[1]) > 0
