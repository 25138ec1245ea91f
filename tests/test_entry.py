import __spark_entry__ as se


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns == ["date", "time", "ccy_cod", "brn", "out_amt", "in_amt", "sum_amt"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from ledgerflow import oracles, workloads
    q, o = se.queries(), se.oracle_sql()
    assert set(o) <= set(q) and set(workloads.REGISTRY) <= set(q)
    assert set(workloads.REGISTRY) == set(oracles.ORACLES)
    assert len(workloads.REGISTRY) >= 43


def test_scale_conf():
    from ledgerflow.session import scale_conf
    small = scale_conf(10 * 1024 ** 2, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    big = scale_conf(100 * 1024 ** 4, total_cores=8000)
    assert big["spark.sql.shuffle.partitions"] == "200000"
    assert big["spark.sql.files.maxPartitionBytes"] == "256m"
