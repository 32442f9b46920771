"""Every query with SQL gives the rows of another engine on the same tables."""

import glob
import numbers
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from helixtext.plans import registry


@pytest.fixture(scope="module")
def other(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def rows(frame):
    columns = sorted(frame.columns)

    def plain(v):
        if hasattr(v, "__len__") and not isinstance(v, str):
            return str(list(v))
        if pd.isna(v):
            return ""
        return str(float(v)) if isinstance(v, numbers.Number) and not isinstance(v, (bool, np.bool_)) else str(v)

    return columns, sorted(tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, other, sf_dir, name):
    got = registry.queries()[name](spark, sf_dir).toPandas()
    assert rows(got) == rows(other.sql(registry.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, sf_dir, name):
    assert registry.queries()[name](spark, sf_dir).count() > 0


def test_previous_token_of_documents(spark, sf_dir):
    rows = registry.queries()["previous_token_of_documents"](spark, sf_dir).orderBy("doc_id", "tok_no").collect()
    assert len({r.doc_id for r in rows}) > 25
    for before, r in zip([None, *rows], rows):
        near = before is not None and before.doc_id == r.doc_id and before.end_off == r.start_off
        residue = near and len(before.token) == 1 and before.token in "CISQMNPKDTFAGHLRWVEYX"
        small = len(r.token) == 2 and all("a" <= c <= "z" for c in r.token)
        assert r.continues_residue == (residue and small)
