"""Compare queries with their SQL: types, row count and exact values.

Run as ``python tests/oracle.py [sf_dir] [name ...]`` or through test_oracle.py.
"""

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def database(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def difference(spark, con, name, run, sql, sf_dir):
    """None when the query and its SQL agree, else what differs."""
    df = run(spark, sf_dir)
    columns = sorted(df.columns)
    spark_types = {f.name: TYPES[f.dataType.simpleString()] for f in df.schema}
    relation = con.sql(sql)
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    if spark_types != duck_types:
        odd = {c for c in {*spark_types, *duck_types} if spark_types.get(c) != duck_types.get(c)}
        return f"types: {[(c, spark_types.get(c), duck_types.get(c)) for c in sorted(odd)]}"
    expected = relation.select(*[f'"{c}"' for c in columns]).fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]

    def key(row):
        return tuple((v is None, v if v is not None else 0) for v in row)

    got, expected = sorted(got, key=key), sorted(expected, key=key)
    if len(got) != len(expected):
        return f"rows: {len(got)} vs {len(expected)}"
    if not expected:
        return "no rows to compare"
    for mine, theirs in zip(got, expected):
        if mine != theirs:
            return f"{columns}: {mine} vs {theirs}"
    return None


def main():
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = database(sf_dir)
    oracles = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = difference(spark, con, name, run, oracles[name], sf_dir)
            else:
                problem = None if run(spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on with the other queries
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
