"""compensated_sums, the query: no row moves, and odd rows count as in its SQL."""

from __future__ import annotations

import twins

from astroloom.plans import exact


def test_no_row_of_compensated_sums_moves_and_odd_rows_count(spark, tmp_path):
    rows = [("A", "F", 7, 10.25, 0.1), ("A", "F", 9, None, 0.3), ("A", "F", 0, 0.0, 0.05), ("B", "O", None, 1.5, None), ("B", "O", 3, 2.25, 0.07)]
    schema = "l_returnflag string, l_linestatus string, l_partkey long, l_extendedprice double, l_discount double"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "w"))
    next((tmp_path / "w").glob("*.parquet")).rename(tmp_path / "lineitem.parquet")
    out = exact.compensated_sums(spark, str(tmp_path))
    assert twins.differ(out, twins.connect(str(tmp_path)), exact.SQL["compensated_sums"]) == ""
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" not in plan and plan.count("Aggregate") == 1
