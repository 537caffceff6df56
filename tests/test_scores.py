"""Scores of tables where percentiles end in half a unit of the last place."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.parity import connect
from tidewright.functions import numbers
from tidewright.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def halves(tmp_path_factory):
    """4,000 suppliers with a line each: 187 ranks in a percentile round one way by decimal spelling, another way by scaling."""
    where = tmp_path_factory.mktemp("halves")
    tables = {
        "supplier": "i AS s_suppkey, 'S' AS s_name, (i % 25)::INT AS s_nationkey, (i * 37 % 9000)::DOUBLE AS s_acctbal",
        "part": "i AS p_partkey, 'p' AS p_name, 'B' || i % 7 AS p_brand",
        "orders": "i AS o_orderkey, i % 50 AS o_custkey",
        "lineitem": "i AS l_orderkey, i AS l_partkey, i AS l_suppkey, (31 + i % 20)::DOUBLE AS l_quantity, (31 + i % 20) * (100.0 + i)::DOUBLE AS l_extendedprice, CASE WHEN i % 3 = 0 THEN 'R' ELSE 'N' END AS l_returnflag",
    }
    for name, columns in tables.items():
        duckdb.sql(f"COPY (SELECT {columns} FROM range(4000) t(i)) TO '{where}/{name}.parquet' (FORMAT parquet)")
    return str(where)


def differing(spark, where, name):
    df = QUERIES[name](spark, where)
    ours = set(map(tuple, df.collect()))
    return len(ours ^ set(connect(where).sql(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()))


def test_rounded_scales_first(spark):
    df = spark.createDataFrame([(0.575,), (100 * (23 / 4000),), (-2.5,), (0.49999999999999994,), (None,), (7.0,)], "v double")
    assert [r["r"] for r in df.select(numbers.rounded(F.col("v"), 2).alias("r")).collect()] == [0.57, 0.57, -2.5, 0.5, None, 7.0]
    assert [r["r"] for r in df.select(numbers.rounded(F.col("v"), 0).alias("r")).collect()] == [1.0, 1.0, -3.0, 0.0, None, 7.0]


def test_risk_score_rounds_as_its_sql_at_halves(spark, halves):
    assert differing(spark, halves, "risk_score") == 0


def test_final_score_rounds_as_its_sql_at_halves(spark, halves):
    assert differing(spark, halves, "final_score") == 0
