"""The gates of stored tables, over a few rows, and the helpers that queries share."""

import ast
from collections import Counter
from datetime import date
from pathlib import Path

import shelfsight
from shelfsight.registry import queries


def test_no_module_defines_a_name_twice():
    """A later helper of the same name takes the place of an earlier one, also for the queries above it."""
    for file in Path(shelfsight.__file__).parent.rglob("*.py"):
        body = ast.parse(file.read_text()).body
        names = Counter(node.name for node in body if isinstance(node, ast.FunctionDef | ast.ClassDef))
        assert not [n for n, times in names.items() if times > 1], file


def test_gates_of_stored_tables(spark, tmp_path):
    parts = [(i, f"red ring {i}", "b", "TIN", 1000.0 + i, 5) for i in range(1, 7)]
    spark.createDataFrame(
        parts, "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double, p_size int"
    ).write.parquet(f"{tmp_path}/part.parquet")
    # Reviews of line 7 have no rating, and so no sentiment; two rows are the same, one has no product.
    lines = [(1, 1, 1), (1, 2, 1), (1, 7, 2), (2, 1, None), (3, 1, 5), (3, 1, 5)]
    spark.createDataFrame(
        [(o, n, p, 1, 10.0, 30.0, date(1998, 1, n), "N", "O") for o, n, p in lines],
        "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_extendedprice double, "
        "l_quantity double, l_shipdate date, l_returnflag string, l_linestatus string",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = queries.gate_stored_products(spark, str(tmp_path)).collect()
    assert [(r["name"], r["passed"], r["observed"]) for r in rows] == [("not_empty", True, 6.0)]
    rows = queries.gate_stored_reviews(spark, str(tmp_path)).collect()
    assert [(r["name"], r["passed"], r["observed"]) for r in rows] == [("not_empty", True, 6.0), ("with_sentiment", True, 5.0)]
