from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.functions import parse as P
from ledgerflow.functions.hashing import poly_hash
from ledgerflow.operators import flows, cells

# The two sample DC messages of the reference producer (out 20000, in 40000).
DC_OUT = ('{"type":"DigitCurrency","send_time":"2021-06-03 15.28.34","data":{"BTSACTNBR":'
          '"95132423559823","BTSCCYNBR":"10","BTSBRNGLG":"110","BTSREGTIM":"2021-06-03 15.28.34",'
          '"BTSTRSAMT":"20000","BTSONLBAL":"49530656","BTSTXTC2G":"N7CP","BTSTRSDIR":"借方",'
          '"BTSRCDVER":"1"}}')
DC_IN = DC_OUT.replace('"20000"', '"40000"').replace('"N7CP"', '"N7PR"')
DC_IGNORED = DC_OUT.replace('"20000"', '"10000"').replace('"N7CP"', '"VF32"')


def lines(spark, *vals):
    return spark.createDataFrame([(v,) for v in vals], "value string")


def test_dc_golden_net_flow(spark):
    tx = P.classify_dc(P.parse_dc(lines(spark, DC_OUT, DC_IN, DC_IGNORED)))
    rows = flows.dc_net_flow(tx).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.date, r.time, r.ccy_cod, r.brn) == ("2021-06-03", "15:28", "10", "110")
    assert (r.out_amt, r.in_amt, r.sum_amt) == (Decimal("-20000.00"), Decimal("40000.00"),
                                                 Decimal("20000.00"))


def test_dc_direction_sum_and_cells(spark):
    tx = P.classify_dc(P.parse_dc(lines(spark, DC_OUT, DC_IN)))
    d = {r.direction: r.amt for r in flows.dc_direction_sum(tx).collect()}
    assert d == {"OUT": Decimal("-20000.00"), "IN": Decimal("40000.00")}
    c = cells.to_cells(flows.dc_net_flow(tx), flows.NET_KEYS).collect()
    assert len(c) == 7 and len({r.rowkey for r in c}) == 1
    assert {r.qualifier: r.value for r in c}["sumAmt"] == "20000.00"


def test_data_as_escaped_string(spark):
    # ``data`` given as an escaped JSON string parses the same as a nested object
    import json
    obj = json.loads(DC_OUT)
    escaped = json.dumps({**obj, "data": json.dumps(obj["data"], ensure_ascii=False)},
                         ensure_ascii=False)
    a = P.parse_dc(lines(spark, DC_OUT)).collect()[0]
    b = P.parse_dc(lines(spark, escaped)).collect()[0]
    assert a == b and a.code == "N7CP"


def test_malformed_rows_become_rejects(spark):
    df = P.classify_dc(P.parse_dc(lines(spark, DC_OUT, "not json", DC_OUT.replace(
        "2021-06-03 15.28.34", "garbage"))))
    ok, bad = P.with_rejects(df, ["date", "time", "amt"])
    assert ok.count() == 1 and bad.count() == 2


def test_fc_and_act_parsers(spark):
    fc = ('{"type":"FCData","send_time":"2021-06-03","data":{"ACT_NBR":"1","ACT_NAM":"x",'
          '"BUS_NBR":"a","BUS_NBR":"b","CCY_NBR":"10","TRX_AMT":"12.5","BOK_DIR":"+"}}')
    r = P.parse_fc(lines(spark, fc)).collect()[0]
    assert (r.act_nbr, r.ccy_cod, r.amt, r.dir) == ("1", "10", Decimal("12.50"), "+")
    act = ('{"send_time":1622708520000,"data":{"type":"kpp","ACTNBR":"9","CCYNBR":"10",'
           '"BRNGLG":"110","REGTIM":"1622708520000","TRSAMT":"10000001","TRSDIR":"D",'
           '"PRDCOD":"95100","RCVEAC":"95100033","PRCSTS":"22"}}')
    a = P.parse_act(lines(spark, act)).collect()[0]
    assert (a.typ, a.reg_tim, a.amt, a.sts) == ("kpp", 1622708520000, Decimal("10000001.00"), "22")


def test_time_helpers(spark):
    df = spark.createDataFrame([("2021-06-03 15.28.34", "2021-06-03 15:28:34")], "a string, b string")
    r = df.select(P.reg_date("a").alias("d"), P.reg_time("a").alias("t"),
                  P.str_to_ts("b").alias("ts"), P.epoch_to_ts(F.lit(1622708520000), "ms").alias("e"),
                  P.uuid_nodash().alias("u")).collect()[0]
    assert (r.d, r.t) == ("2021-06-03", "15:28")
    assert r.ts.hour == 15 and len(r.u) == 32 and "-" not in r.u


def test_poly_hash_matches_python(spark):
    def ref(s, seed=61, cap=1 << 29):
        h = 0
        for ch in s:
            h = h * seed + ord(ch)
        return h & (cap - 1)
    vals = ["0", "1", "149", "95132423559823", "user_1"]
    got = spark.createDataFrame([(v,) for v in vals], "s string").select(
        "s", poly_hash("s").alias("h")).collect()
    assert {r.s: r.h for r in got} == {v: ref(v) for v in vals}


def test_each_record_is_parsed_once(spark):
    from conftest import SF_SMALL
    from ledgerflow import workloads
    for name in ("src_json_lines", "src_fc_lines", "src_act_lines"):
        df = workloads.REGISTRY[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert 1 <= plan.count("from_json") <= 2, name
