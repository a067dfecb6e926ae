"""Run registered queries beside their SQL on one scale and compare the results.

    python -m parity.check [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from parity.oracle import ORACLE
from parity.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True, na_position="first")


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> str:
    """'' when both sides agree on columns, types and values, else what differs."""
    ours = QUERIES[name](spark, sf_dir).toArrow()
    theirs = con.sql(ORACLE[name]).to_arrow_table()

    def types(table):
        return {f.name: str(f.type).replace("large_", "") for f in table.schema}

    if types(ours) != types(theirs):
        return f"schema: {types(ours)} / {types(theirs)}"
    if ours.num_rows != theirs.num_rows:
        return f"rows: {ours.num_rows} / {theirs.num_rows}"
    left, right = canonical(ours.to_pandas()), canonical(theirs.to_pandas())
    same = (left == right) | (left.isna() & right.isna())
    if same.all(axis=None):
        return ""
    bad = ~same.all(axis=1)
    return f"{int(bad.sum())} rows differ:\n{left[bad].head(3)}\n{right[bad].head(3)}"


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = session(), duck(sf_dir)
    failed = 0
    for name in argv[1:] or QUERIES:
        begin = time.time()
        if name in ORACLE:
            verdict = compare(spark, con, name, sf_dir) or "same"
        else:
            verdict = f"no SQL, {QUERIES[name](spark, sf_dir).count()} rows"
        failed += verdict.startswith(("schema", "rows")) or "differ" in verdict
        print(f"{name:28} {time.time() - begin:6.1f}s  {verdict}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
