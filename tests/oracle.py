"""Compare a Spark result with DuckDB's on the same Parquet tables:
columns sorted by name, rows compared as a bag."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

from relkit.sources import TABLES


def duck(data_dir: str, tables=TABLES) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in tables:
        path = f"{data_dir}/{t}.parquet"
        if os.path.isdir(path):                 # written by Spark: a folder of parts
            path += "/*.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _sorted(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows),
                  key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                      for x in r))


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    """Rows of a pandas frame, where null and NaN cannot be told apart."""
    pdf = pdf.astype(object).where(pd.notna(pdf), None)
    return _sorted(list(pdf.itertuples(index=False)), list(pdf.columns))


def compare(spark_df, con, sql: str, rel_tol: float = 0.0) -> tuple[bool, str]:
    s = spark_df.collect()                       # null and NaN stay apart
    got = con.execute(sql)
    columns = [c[0] for c in got.description]
    d = got.fetchall()
    if sorted(spark_df.columns) != sorted(columns):
        return False, f"columns differ: {sorted(spark_df.columns)} vs {sorted(columns)}"
    if len(s) != len(d):
        return False, f"row count {len(s)} vs {len(d)}"
    rs, rd = _sorted(s, spark_df.columns), _sorted(d, columns)
    for a, b in zip(rs, rd):
        for x, y in zip(a, b):
            if isinstance(x, float) and isinstance(y, float):
                if not math.isclose(x, y, rel_tol=rel_tol, abs_tol=0.0) and x != y:
                    return False, f"row differs: {a} vs {b}"
            elif x != y:
                return False, f"row differs: {a} vs {b}"
    return True, f"{len(s)} rows"
