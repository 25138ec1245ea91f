import pandas as pd

from conftest import SF_SMALL
from ledgerflow.operators import patterns
from ledgerflow.sources import tables as tb


def run(order_log, **kw):
    m, t = patterns.followed_by(order_log, "order_id", "event_type", "create", "pay",
                                "15 minutes", **kw)
    return m.collect(), t.collect()


def test_order_log_golden(order_log):
    assert order_log.count() == 79
    m, t = run(order_log)
    assert len(m) == 37
    assert sorted(r.order_id for r in t) == [34756, 34767]
    assert 34768 not in {r.order_id for r in m} | {r.order_id for r in t}
    assert all(r.result == "payed successfully" for r in m)


def test_order_log_strict_late(order_log):
    m, t = run(order_log, strict_late=True)
    assert len(m) == 36
    assert sorted(r.order_id for r in t) == [34747, 34756, 34767]


def test_block_length_does_not_change_result(order_log):
    a = run(order_log)
    b = run(order_log, block="10 seconds")
    assert sorted(map(tuple, a[0])) == sorted(map(tuple, b[0]))
    assert sorted(map(tuple, a[1])) == sorted(map(tuple, b[1]))


def brute_force(pdf: pd.DataFrame, within_s: float):
    """Each create pairs with the first later pay of its order (by time, then arrival)."""
    out = {}
    for oid, g in pdf.sort_values(["ts", "seq"]).groupby("order_id"):
        rows = list(g.itertuples())
        for i, r in enumerate(rows):
            if r.event_type != "create":
                continue
            nxt = next((p for p in rows[i + 1:] if p.event_type == "pay"), None)
            ok = nxt is not None and (nxt.ts - r.ts).total_seconds() < within_s
            out[r.seq] = nxt.seq if ok else None
    return out


def test_events_against_brute_force(spark):
    o = tb.events_as_orders(tb.load_table(spark, SF_SMALL, "events"))
    for within, secs in (("12 hours", 43200), ("3 days", 259200)):
        m, t = patterns.followed_by(o, "order_id", "event_type", "create", "pay", within)
        got = {r.first_seq: r.next_seq for r in m.collect()}
        got.update({r.first_seq: None for r in t.collect()})
        assert got == brute_force(o.toPandas(), secs)
