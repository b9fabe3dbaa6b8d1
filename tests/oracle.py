"""Runs registered queries beside their DuckDB SQL and compares the values.

    python tests/oracle.py [folder of Parquet tables] [query name ...]
"""

import datetime
import os
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


SPARK_SECONDS = []


def local_session(cpus: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TEST_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if hasattr(value, "as_tuple"):
        return round(float(value), 9)
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def difference(spark, connection, sf_dir: str, run, sql: str) -> str | None:
    """None if both sides agree, else what differs."""
    started = time.time()
    frame = run(spark, sf_dir)
    ours = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    SPARK_SECONDS.append(time.time() - started)
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    theirs = canonical(names, cursor.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        only = sorted(set(ours) - set(theirs), key=repr)[:2]
        missing = sorted(set(theirs) - set(ours), key=repr)[:2]
        return f"{len(ours)} rows against {len(theirs)}; only ours {only}, missing {missing}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} against {b}"
    return None


def main() -> int:
    sys.path.insert(0, str(ROOT))
    from coterie.plans.catalog import ALL_QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(ALL_QUERIES)
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    for name in names:
        query = ALL_QUERIES[name]
        started = time.time()
        try:
            if query.sql:
                problem = difference(spark, connection, sf_dir, query.run, query.sql)
            else:
                rows = query.run(spark, sf_dir).count()
                problem = None if rows else "no rows"
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        kind = "sql" if query.sql else "rows"
        taken = f"{time.time() - started:6.1f}s, Spark {SPARK_SECONDS[-1] if SPARK_SECONDS else 0:.1f}s"
        print(f"{name:32s} {kind} {taken} {problem or 'ok'}", flush=True)
    print(f"{len(names) - failures} of {len(names)} agree")
    return failures


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
