"""Run every registered query next to its SQL in DuckDB and compare all values."""

from __future__ import annotations

import math
import os
from datetime import datetime
from decimal import Decimal
from pathlib import Path


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def normal(value):
    if isinstance(value, bool) or value is None or isinstance(value, str | datetime):
        return value
    if isinstance(value, Decimal):
        raise AssertionError("decimals do not belong into compared results")
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    return value


def compare(spark, connection, name, function, sql, sf_dir):
    frame = function(spark, sf_dir)
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns), (name, sorted(names), sorted(frame.columns))
    order = sorted(names)
    expected = [[normal(r[names.index(c)]) for c in order] for r in result.fetchall()]
    got = [[normal(r[frame.columns.index(c)]) for c in order] for r in frame.collect()]
    expected.sort(key=repr)
    got.sort(key=repr)
    assert len(got) == len(expected), (name, len(got), len(expected))
    for g, e in zip(got, expected):
        assert g == e and [type(x) for x in g] == [type(x) for x in e], (name, order, g, e)
    return len(got)


SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
