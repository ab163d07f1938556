"""Compare a query with its SQL over the same parquet."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v.replace(tzinfo=None) if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def expected(sql, sf_dir):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = db.execute(sql)
    columns = [d[0] for d in found.description]
    return sorted(columns), rows_of(columns, found.fetchall())


def actual(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])
