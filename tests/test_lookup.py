"""Exclusion lists: the filter and the join give the same rows, and the filter shuffles only what it
cannot clear."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from ledgerflow import workloads
from ledgerflow.operators import lookup


def _rows(df):
    return sorted(map(str, df.collect()))


def _case(spark):
    left = spark.range(5000).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 11 > 0, (F.col("id") % 700).cast("string")).alias("act_nbr"),
        F.when(F.col("id") % 13 > 0, (F.col("id") % 3).cast("string")).alias("ccy_cod"), F.lit(1).alias("_lf_word"))
    right = spark.range(900).select((F.col("id") * 3 % 1000).cast("string").alias("act_nbr"),
                                    F.when(F.col("id") % 5 > 0, (F.col("id") % 3).cast("string")).alias("ccy_cod"))
    return left, right.unionAll(right.limit(3)).unionAll(right.selectExpr("cast(null as string)", "'1'").limit(1))


@pytest.mark.parametrize("bits", [64, 1024, 1 << 20])
def test_filter_equals_join(spark, bits):
    left, right = _case(spark)
    left = left.withColumnRenamed("_lf_word", "extra")
    want = _rows(lookup.anti_filter(left, right, method="join"))
    assert _rows(lookup.anti_filter(left, right, method="filter", bits=bits)) == want
    assert 0 < len(want) < 5000
    assert lookup.anti_filter(left, right.limit(0), method="filter").count() == 5000
    assert lookup.anti_filter(left.limit(0), right, method="filter").count() == 0


def test_long_lists_take_the_filter_and_shuffle_what_it_holds(spark):
    from ledgerflow.sources import tables as tb
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    with_list = {n: _rows(workloads.REGISTRY[n](spark, SF_MID)) for n in ("fc_anti", "fc_sum")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for n, want in with_list.items():
            assert _rows(workloads.REGISTRY[n](spark, SF_MID)) == want
        df = workloads.REGISTRY["fc_anti"](spark, SF_MID)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "LeftSemi" in plan and "LeftAnti" in plan
        # the exact join's shuffle lies above the semi join with the bits; the cleared rows have none
        events = tb.events_as_fc(tb.load_table(spark, SF_MID, "events"))
        listed = tb.exclusion_list(tb.load_table(spark, SF_MID, "customer"))
        words = lookup.key_bitmap(listed.selectExpr("act_nbr _x_act_nbr", "ccy_cod _x_ccy_cod"),
                                  ["_x_act_nbr", "_x_ccy_cod"])
        h = events.select(lookup._hashed(["act_nbr", "ccy_cod"], lookup.FILTER_BITS).alias("h"))
        held = h.join(words, (F.shiftright("h", 6) == F.col("_lf_word")) & (
            F.expr("shiftright(_lf_mask, cast(h % 64 as int)) & 1L") == 1)).count()
        dropped = events.count() - len(with_list["fc_anti"])
        assert dropped <= held <= dropped + 0.001 * events.count() + 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
