from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerflow.functions.parse import classify_dc
from ledgerflow.operators import flows
from ledgerflow.sources import tables as tb


def _tx(spark):
    return classify_dc(tb.events_as_dc(tb.load_table(spark, SF_SMALL, "events")))


def test_running_total_blocked_equals_plain(spark):
    keys = ["act_nbr", "ccy_cod", "brn"]
    win = flows.dc_window_inout(_tx(spark), "1 hour", time_col="ts", keys=keys)
    plain = flows.dc_running_total(win, keys=keys)
    blocked = flows.dc_running_total(win, keys=keys, block=F.dayofyear("window_end"))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, blocked.collect()))


def test_unmatched_codes_form_one_zero_group(spark):
    tx = _tx(spark)
    kept = flows.dc_tumbling_sum(tx, "1 hour", time_col="ts", keep_unmatched=True)
    nulls = kept.where("direction IS NULL")
    assert nulls.count() > 0 and nulls.where("amt <> 0").count() == 0
    assert nulls.groupBy("window_start").count().where("count > 1").count() == 0
    assert nulls.where("coalesce(date, time, ccy_cod, brn) IS NOT NULL").count() == 0
    dropped = flows.dc_tumbling_sum(tx, "1 hour", time_col="ts")
    assert dropped.where("direction IS NULL").count() == 0
    assert kept.count() - nulls.count() == dropped.count()


def test_net_flow_equals_direction_sums(spark):
    tx = _tx(spark)
    net = {tuple(r[:4]): (r.out_amt, r.in_amt, r.sum_amt) for r in flows.dc_net_flow(tx).collect()}
    d = {}
    for r in flows.dc_direction_sum(tx).collect():
        o, i = d.get(tuple(r[:4]), (0, 0))
        d[tuple(r[:4])] = (o + r.amt, i) if r.direction == "OUT" else (o, i + r.amt)
    assert net == {k: (o, i, o + i) for k, (o, i) in d.items()}


def test_anti_filter_null_parts_and_duplicates(spark):
    from ledgerflow.operators.lookup import anti_filter
    rows = spark.createDataFrame([("a", "10", 1), ("a", None, 2), ("b", "10", 3), (None, "20", 4)],
                                 "act_nbr string, ccy_cod string, v int")
    # a null part matches the text 'null' (keys were built by string concatenation)
    excl = spark.createDataFrame([("a", "null"), ("b", "10"), ("b", "10")],
                                 "act_nbr string, ccy_cod string")
    for bound in ("10m", "-1"):  # broadcast and shuffle paths
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        kept = sorted(r.v for r in anti_filter(rows, excl).collect())
        assert kept == [1, 4], bound
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cells_of_two_batches_keep_all_money(spark):
    from ledgerflow.operators.cells import to_cells
    keys = ["date", "time", "ccy_cod", "brn"]
    cols = ["date", "time", "ccy_cod", "brn", "out_amt", "in_amt", "sum_amt"]
    def net(*rows):
        return spark.createDataFrame([(*r[:4], *map(Decimal, r[4:])) for r in rows],
                                     "date string, time string, ccy_cod string, brn string, "
                                     "out_amt decimal(38,2), in_amt decimal(38,2), sum_amt decimal(38,2)")
    assert cols == net(("d", "t", "1", "2", "0", "1", "1")).columns
    one = to_cells(net(("d", "t", "1", "2", "0", "100", "100")), keys, batch_id=1)
    two = to_cells(net(("d", "t", "1", "2", "0", "250", "250")), keys, batch_id=2)
    store = {(r.rowkey, r.qualifier): r.value for r in one.union(two).collect()}
    assert sum(Decimal(v) for (_, q), v in store.items() if q == "sumAmt") == 350
    odd = to_cells(net(("a|b", "c", "1", "2", "0", "0", "0"), ("a", "b|c", "1", "2", "0", "0", "0"),
                       ("", "c", "1", "2", "0", "0", "0"), (None, "c", "1", "2", "0", "0", "0")), keys)
    assert odd.select("rowkey").distinct().count() == 4
