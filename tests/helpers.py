import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return c


def rows(df: pd.DataFrame) -> list[str]:
    df = df[sorted(df.columns)].astype(object)
    return sorted(map(str, df.where(df.notna(), None).values.tolist()))


def same(spark_df, duck_df):
    a, b = spark_df.toPandas(), duck_df
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
