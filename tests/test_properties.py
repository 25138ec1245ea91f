"""Property check of the blocked prefix scan against a plain window, on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.plans import running

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "hot", "hot", "hot", None]),
              st.one_of(st.none(), st.integers(-100, 100))),
    min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, block=st.integers(1, 9), fanout=st.sampled_from([None, 2, 3]),
       inclusive=st.booleans())
def test_running_matches_window(spark, rows, block, fanout, inclusive):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)],
                               "seq long, g string, v long")
    frame = Window.partitionBy("g").orderBy("seq").rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    want = df.select("seq", F.sum("v").over(frame).alias("s"), F.count("v").over(frame).alias("c"),
                     F.max("v").over(frame).alias("m"))
    got = running(df, ["g"], [F.col("seq")], F.floor(F.col("seq") / block),
                  {"s": ("sum", "v"), "c": ("count", "v"), "m": ("max", "v")},
                  inclusive=inclusive, fanout=fanout)
    assert sorted(map(tuple, got.select("seq", "s", "c", "m").collect())) == \
        sorted(map(tuple, want.collect()))
