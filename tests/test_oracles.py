"""The registered queries against their DuckDB statements on the smallest data set."""
import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from postalspark.fixtures import BASE_TABLES

SKIP_SLOW = {"S7", "S8", "T1", "T2", "T3", "T4", "T5", "P1"}


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


NAMES = [n for n in entry.oracle_sql() if n.split("_")[0] not in SKIP_SLOW]

# DuckDB result types and the Spark types they correspond to.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean", "DOUBLE": "double",
         "TIMESTAMP": "timestamp_ntz"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, con, name):
    df = entry.queries()[name](spark, sf_small)
    res = con.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert dict(df.dtypes) == {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in res.description}
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(d_cols, res.fetchall())


def test_every_query_of_the_inventory_has_an_oracle():
    from postalspark.plans.catalog import registered
    from postalspark.plans.oracles import oracles
    assert set(registered()) == set(oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_works_without_the_training_data_operators(tmp_path):
    """The folders may be deleted: a copy without them still imports and lists the inventory."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/postalspark", tmp_path / "postalspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.queries()) ^ set(e.oracle_sql())))"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.stdout.strip().endswith("[]"), out.stderr[-500:]


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["uf", "codes", "distinct_codes"]
