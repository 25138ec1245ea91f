"""Stores of the sinks: compaction that may die anywhere, bounded files, replays."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerflow import streaming as S
from ledgerflow.streaming import runners, store
from test_streaming import _write_files


def _batch(spark, root, n, rows):
    spark.createDataFrame(rows, "k string, v long").write.mode("overwrite").parquet(f"{root}/batch_id={n}")


def _merge(rows):
    return runners.newest(rows, ["k"])


def _values(spark, root):
    return {r.k: r.v for r in S.latest(spark, root, ["k"]).collect()}


def _files(root):
    return sum(f.endswith(".parquet") for _, _, fs in os.walk(root) for f in fs)


@pytest.mark.parametrize("dies_in", ["snapshot", "swap", "first drop", "second drop"])
def test_compaction_killed_halfway(spark, scratch, monkeypatch, dies_in):
    root = os.path.join(scratch, "store")
    for n in range(6):
        _batch(spark, root, n, [("a", n), (f"k{n}", 10 * n)])
    store.compact(spark, root, 2, _merge)
    want = _values(spark, root)
    assert want == {"a": 5, **{f"k{n}": 10 * n for n in range(6)}}

    def die(*a, **k):
        raise RuntimeError("killed")
    calls = []

    def second(*a, **k):
        calls.append(a)
        return die() if len(calls) > 1 else drop_before(*a, **k)
    drop_before = store.drop_before
    with monkeypatch.context() as m:
        if dies_in == "snapshot":  # some files are there, but the folder is not complete
            def merge(rows):
                rows.write.parquet(f"{root}/_snapshots/through=4")
                os.remove(f"{root}/_snapshots/through=4/_SUCCESS")
                die()
        else:
            merge = _merge
            m.setattr(store, "_swap" if dies_in == "swap" else "drop_before", die if dies_in in ("swap", "first drop") else second)
        with pytest.raises(RuntimeError):
            store.compact(spark, root, 4, merge)
    assert _values(spark, root) == want
    _batch(spark, root, 6, [("a", 6)])
    store.compact(spark, root, 5, _merge)
    assert _values(spark, root) == {**want, "a": 6}
    # a replay of the batch that is not merged yet
    _batch(spark, root, 6, [("a", 7)])
    assert _values(spark, root) == {**want, "a": 7}


def test_files_stay_bounded(spark, scratch):
    root, most = os.path.join(scratch, "store"), 0
    for n in range(24):
        _batch(spark, root, n, [("a", n), (f"k{n % 3}", n)])
        if n and n % 4 == 0:
            store.compact(spark, root, n - 1, _merge)
        most = max(most, len(store.folders(spark, root)))
    assert _values(spark, root) == {"a": 23, "k0": 21, "k1": 22, "k2": 23}
    assert most <= 2 * 4 + 1 and len(store.folders(spark, f"{root}/_snapshots", "through")) <= 2
    assert len(store.folders(spark, f"{root}/_manifest", "through")) <= 2
    rows = store.read(spark, root)
    assert rows.columns == ["k", "v", "batch_id"] and rows.count() <= 4 + 2 * 8


def test_upsert_sink_compacts(spark, scratch):
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    frames = [spark.createDataFrame([(f"k{i % 2}", i)], "k string, v long") for i in range(9)]
    _write_files(frames, src)
    stream = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(src)
    counts = stream.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("v"))
    S.upsert_sink(counts, ["k"], out, checkpoint=os.path.join(scratch, "ck"), compact_every=3).awaitTermination()
    assert {tuple(r) for r in S.latest(spark, out, ["k"]).collect()} == {("k0", 5, 8), ("k1", 4, 7)}
    assert store.folders(spark, f"{out}/_manifest", "through") and len(store.folders(spark, out)) < 9


def test_totals_of_a_cumulative_sink_stay_bounded_and_survive_replays(spark, scratch):
    src, out, ck = (os.path.join(scratch, x) for x in ("src", "out", "ck"))
    frames = [spark.createDataFrame([(f"k{(i * 7 + j) % 10}", i, j + 1) for j in range(4)], "k string, o long, v long")
              for i in range(12)]
    _write_files(frames, src)

    def run():
        stream = spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(src)
        S.cumulative_sink(stream, ["k"], "o", ["v"], out, checkpoint=ck, buckets=4).awaitTermination()

    def emitted():
        return sorted((r.k, r.o, r.v, r.cum_v) for r in spark.read.parquet(f"{out}/emitted").collect())
    run()
    first, totals, want = emitted(), {}, []
    for i, f in enumerate(frames):
        for k, o, v in sorted(map(tuple, f.collect())):
            totals[k] = totals.get(k, 0) + v
            want.append((k, o, v, totals[k]))
    assert first == sorted(want)
    assert store.folders(spark, f"{out}/_index") == [10, 11]
    buckets = [d for d, _, _ in os.walk(f"{out}/_totals") if "_bucket=" in d]
    assert len(buckets) <= 2 * 4
    os.remove(f"{ck}/commits/11")
    if os.path.exists(f"{ck}/commits/.11.crc"):
        os.remove(f"{ck}/commits/.11.crc")
    run()
    assert emitted() == first
