"""Compare every registered query with its SQL: names, types, row count and values.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split(" ")
SPARK_NAMES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def duck_type(spark_type: str) -> str:
    return SPARK_NAMES.get(spark_type, spark_type.upper())


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, oracle: str) -> list[str]:
    expected = connection.execute(oracle)
    names = [d[0] for d in expected.description]
    kinds = {name: str(kind) for name, kind in zip(names, [d[1] for d in connection.description], strict=True)}
    wanted = expected.fetchall()
    found = result.collect()
    problems = []
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} instead of {sorted(names)}"]
    for field in result.schema.fields:
        if duck_type(field.dataType.simpleString()).replace(" ", "") != kinds[field.name].replace(" ", ""):
            problems.append(f"type of {field.name}: {field.dataType.simpleString()} instead of {kinds[field.name]}")
    order = sorted(names)
    left = Counter(tuple(row[c] for c in order) for row in found)
    right = Counter(tuple(row[names.index(c)] for c in order) for row in wanted)
    if len(found) != len(wanted):
        problems.append(f"{len(found)} rows instead of {len(wanted)}")
    if left != right:
        problems.append(f"surplus {list((left - right).items())[:3]}, missing {list((right - left).items())[:3]}")
    return problems


def main(sf_dir: str, only: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles, failures = connect(sf_dir), oracle_sql(), 0
    for name, function in queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            result = function(spark, sf_dir)
            if name in oracles:
                problems = differences(result, connection, oracles[name])
            else:
                problems = [] if result.collect() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failures += bool(problems)
        print(f"{'FAIL' if problems else 'ok':4} {name} {time.time() - started:.2f}s", *problems, sep="\n       ")
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:]))
