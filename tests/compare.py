"""Run a registered query in Spark and its SQL in DuckDB over the same tables, and compare all rows."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(frame) -> list[str]:
    def plain(x):
        if x is None or x != x:
            return None
        return x.item() if hasattr(x, "item") else x

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(repr([plain(x) for x in r]) for r in frame.itertuples(index=False))


def compare(spark, query, sql: str, sf_dir: str) -> int:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    mine, theirs = query(spark, sf_dir).toPandas(), con.execute(sql).fetch_df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)
    return len(mine)
