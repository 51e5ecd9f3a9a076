"""Helpers of these tests that are no fixtures."""

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"


def rows_of(path):
    return pq.read_table(path).to_pylist()


def oracle(sql, sf_dir=SMALL):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(([r[i] for i in order] for r in cur.fetchall()), key=str)


def sorted_rows(df):
    names = sorted(df.columns)
    return names, sorted(([r[n] for n in names] for r in df.collect()), key=str)
