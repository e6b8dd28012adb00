"""All queries: equal to their SQL, and without a crash on empty, null and clashing tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from corpusloom.plans.queries import ORACLE, QUERIES
from tests.conftest import DATA

KEYS = {"row_id", "pool_id", "doc_id", "item_id", "vec_id", "event_id", "o_orderkey", "l_orderkey", "p_partkey", "c_custkey", "s_suppkey", "n_nationkey", "r_regionkey"}


def plain(v):
    if v is None or isinstance(v, bool):
        return str(v)
    try:
        return f"{float(v):.6g}" if not isinstance(v, str) else v
    except (TypeError, ValueError):
        return str(v)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    cur = duck.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    want = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cur.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in df.collect()) == want


def variant(kind: str, folder) -> str:
    for f in glob.glob(f"{DATA}/*.parquet"):
        t = pq.read_table(f)
        if kind == "empty":
            t = t.slice(0, 0)
        elif kind == "nulls":
            h = t.slice(0, 20)
            cols = [h[c] if c in KEYS else pa.nulls(h.num_rows, h[c].type) for c in h.column_names]
            again = [x.slice(0, 3) for x in cols]
            t = pa.concat_tables([pa.table(cols, names=h.column_names), pa.table(again, names=h.column_names)]).cast(h.schema)
        else:
            for n in ("_key", "_r", "_row", "_s", "_e", "n", "seg", "words", "label"):
                if n not in t.column_names:
                    t = t.append_column(n, pa.array(["x"] * t.num_rows))
        pq.write_table(t, f"{folder}/{os.path.basename(f)}")
    return str(folder)


@pytest.mark.parametrize("kind", ["empty", "nulls", "clash"])
def test_odd_tables(spark, data, tmp_path, kind):
    folder = variant(kind, tmp_path)
    for name, fn in QUERIES.items():
        try:
            fn(spark, folder).collect()
        except Exception as e:
            raise AssertionError(f"{name} over {kind} tables") from e
