"""Plan-level guarantees of every registered query (planned, not executed)."""

import re

import pytest

from tidemark.plans.catalog import NO_ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
# Columns no query needs: reading them would mean pruning failed.
NEVER_READ = {"event_id", "value", "l_orderkey", "l_linenumber", "l_tax", "l_returnflag", "l_linestatus",
              "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"}
# read back a table or a model, or gather sums
WRITES_FIRST = {"category_index", "typed_demand_table", "score_batch_checks", "predict_batch_rows", "train_quality", "first_split", "predict_from_state",
                "refreshed_features"}
PLANNED = sorted(n for n in QUERIES if n not in NO_ORACLE | WRITES_FIRST and not n.startswith(("stream_", "sales_drops_")))


@pytest.mark.parametrize("name", PLANNED)
def test_plan_shape(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, (name, bad)
    read = {c.strip().split("#")[0] for s in re.findall(r"FileScan (?:parquet|csv|json) [^\[]*\[([^\]]*)\]", plan)
            for c in s.split(",")}
    assert read and not (read & NEVER_READ), (name, read & NEVER_READ)
