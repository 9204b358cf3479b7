"""The landed registrations: whole rows move once, and every event name survives."""

import datetime as dt
import io
from contextlib import redirect_stdout

from rsvpark.sources.fixture import build_reg, load_reg


def _tables(spark, at):
    day = dt.date(2024, 1, 2)
    orders = [(k, 1, s, 10.0, day, "1-URGENT") for k, s in ((2, "O"), (3, ""), (4, None), (5, "O"))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame([(1, "AUTO")], "c_custkey long, c_mktsegment string").write.parquet(f"{at}/customer.parquet")
    items = [(2, 7), (2, 8), (2, 7), (2, 9), (3, 9), (None, 8), (5, None)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long").write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(7, "B"), (8, "A"), (9, "B")], "p_partkey long, p_type string").write.parquet(f"{at}/part.parquet")
    spark.createDataFrame([(2, "why?"), (9, "nobody's")], "doc_id long, text string").write.parquet(f"{at}/documents.parquet")


def test_landed_rows_are_those_of_the_view(spark, workdir):
    _tables(spark, workdir)
    landed, view = load_reg(spark, workdir), build_reg(spark, workdir)
    assert sorted(map(str, landed.collect())) == sorted(map(str, view.collect()))
    got = {r.row_id: (r.event_id, r.role, r.speaker_q) for r in landed.collect()}
    # an empty event name was read back as null from its folder
    assert got == {2: ("O", "A | B", "why?"), 3: ("", "B", "无"), 4: (None, None, "  "), 5: ("O", None, None)}


def test_no_set_is_built_before_its_order_is_in_one_place(spark, workdir):
    _tables(spark, workdir)
    out = io.StringIO()
    with redirect_stdout(out):
        build_reg(spark, workdir).explain()
    plan = out.getvalue().splitlines()
    partial = next(i for i, x in enumerate(plan) if "partial_collect_set" in x)
    # the exchange by order is below both halves of the aggregate, so no partial set moves or is sorted for a move
    assert "Exchange" not in plan[partial - 1] and "hashpartitioning(l_orderkey" in " ".join(plan[partial + 1: partial + 3])
