"""Spark results against DuckDB SQL over the same tables."""

import os

import duckdb


def number(v):
    v = round(float(v), 6) + 0.0
    return str(int(v)) if v.is_integer() else str(v)


def rows_of(frame):
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        known = frame[c].notna()
        if str(frame[c].dtype).startswith("float"):
            frame[c] = frame[c].map(number, na_action="ignore")  # a nullable long is a float here and none there
        frame[c] = frame[c].astype(str).where(known, "null")
    return list(frame.columns), sorted(map(tuple, frame.to_numpy().tolist()))


def database(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return con
