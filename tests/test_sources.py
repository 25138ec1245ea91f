import os

import pytest

from ledgerflow.schemas import USER_BEHAVIOR
from ledgerflow.sources.feeds import read_csv_feed, source


def test_text_source_batch_and_stream(spark, scratch):
    p = os.path.join(scratch, "lines")
    os.makedirs(p)
    with open(os.path.join(p, "a.txt"), "w") as f:
        f.write("one\ntwo\n")
    assert sorted(r.value for r in source(spark, "text", streaming=False, path=p).collect()) == \
        ["one", "two"]
    s = source(spark, "text", path=p, max_files_per_trigger=1)
    assert s.isStreaming and s.columns == ["value"]


def test_csv_feed_trims_padded_fields(spark, scratch):
    p = os.path.join(scratch, "ub")
    os.makedirs(p)
    with open(os.path.join(p, "ub.csv"), "w") as f:
        f.write(" 1 , 10 ,3, pv ,1511658000\n2,11,3,buy,1511658001\nbad,row\n")
    rows = read_csv_feed(spark, p, USER_BEHAVIOR).collect()
    assert (rows[0].user_id, rows[0].behavior, rows[0].timestamp) == (1, "pv", 1511658000)
    assert rows[2].user_id is None  # permissive: unparsable fields become null


def test_source_argument_errors(spark):
    with pytest.raises(ValueError):
        source(spark, "socket", streaming=False, host="localhost", port=1)
    with pytest.raises(ValueError):
        source(spark, "nope")


def test_kafka_options_without_a_broker():
    from ledgerflow.sources.feeds import kafka_options, offsets_json
    stream = kafka_options("h:1", "t", max_per_trigger=15, group_prefix="g", **{"kafka.client.id": "c"})
    assert stream == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest",
                      "failOnDataLoss": "true", "maxOffsetsPerTrigger": "15", "groupIdPrefix": "g",
                      "kafka.client.id": "c"}
    text = offsets_json([{"topic": "t", "partition": 1, "next_offset": 7}])
    assert text == '{"t": {"1": 7}}'
    batch = kafka_options("h:1", "t", streaming=False, starting=text, ending="latest",
                          fail_on_data_loss=False)
    assert batch["startingOffsets"] == text and batch["endingOffsets"] == "latest"
    assert batch["failOnDataLoss"] == "false" and "maxOffsetsPerTrigger" not in batch
    for bad in ({"ending": "latest"}, {"streaming": False, "starting": "latest"}):
        with pytest.raises(ValueError):
            kafka_options("h:1", "t", **bad)


def test_interval_texts():
    from ledgerflow.plans.panes import interval_us
    assert interval_us("500 milliseconds") == 500_000
    assert interval_us("1 hour 30 minutes") == 5_400_000_000
    with pytest.raises(ValueError):
        interval_us("hour")


def test_grouped_aggregate_extension_point(spark):
    from ledgerflow.operators.custom import grouped_aggregate
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 4.0), ("b", 5.0, 6.0)], "k string, x double, y double")
    got = {r.k: r.value for r in grouped_aggregate(
        df, ["k"], lambda x, y: float((x * y).sum()), ["x", "y"], "double").collect()}
    assert got == {"a": 14.0, "b": 30.0}
