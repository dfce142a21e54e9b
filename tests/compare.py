"""Run a registered query and its SQL on the same tables and compare all rows."""

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql):
    """Empty text when equal, else what differs."""
    found = spark_df.collect()
    left_names = spark_df.columns
    cursor = con.execute(sql)
    right_names = [d[0] for d in cursor.description]
    wanted = cursor.fetchall()
    if sorted(left_names) != sorted(right_names):
        return f"columns {sorted(left_names)} != {sorted(right_names)}"
    left, right = rows_of(left_names, found), rows_of(right_names, wanted)
    if left == right:
        return "" if left else "EMPTY"
    a, b = set(left), set(right)
    return (f"rows {len(left)} vs {len(right)}; names {sorted(left_names)}; only here {sorted(a - b)[:3]}; "
            f"only there {sorted(b - a)[:3]}; {len(a-b)} / {len(b-a)}")
