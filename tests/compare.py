"""Compare a query with its SQL."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, float):
        return round(value, 6)
    return value if isinstance(value, (bool, str)) else int(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(str(tuple(plain(r[i]) for i in order)) for r in rows)


def same(spark, sf_dir, query, sql):
    df = query(spark, sf_dir)
    cursor = connection(sf_dir).execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    ours, theirs = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(names, cursor.fetchall())
    assert ours == theirs
    return len(ours)
