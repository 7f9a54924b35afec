"""Compare every query with its SQL: row count, columns, types and values."""

from __future__ import annotations

import argparse
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from .oracles import ORACLES
from .queries import QUERIES
from .views import TABLES

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def compare(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Empty text if both sides agree, else what differs."""
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    expected = database.execute(ORACLES[name])
    wanted_types = {column[0]: str(column[1]) for column in expected.description}
    wanted_rows = expected.fetchall()
    order = [column[0] for column in expected.description]

    result = QUERIES[name](spark, sf_dir)
    types = {field.name: TYPES[field.dataType.simpleString()] for field in result.schema}
    if types != wanted_types:
        return f"columns {types} instead of {wanted_types}"
    rows = Counter(tuple(row) for row in result.select(*order).collect())
    wanted = Counter(wanted_rows)
    if rows != wanted:
        extra, absent = rows - wanted, wanted - rows
        return f"{sum(extra.values())} rows too many, {sum(absent.values())} absent: " + str(
            [list(extra.items())[:1], list(absent.items())[:1]]
        )
    return "" if rows else "no rows on either side"


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("sf_dir")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in options.names or QUERIES:
        start = time.time()
        difference = compare(spark, options.sf_dir, name)
        print(f"{name:22} {time.time() - start:6.2f}s  {difference[:700] or 'equal'}", flush=True)


if __name__ == "__main__":
    main()
