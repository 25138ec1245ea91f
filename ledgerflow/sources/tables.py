"""Parquet tables and the feed-shaped views the operators consume.

The driver tables stand in for the reference's message feeds: ``events`` plays the DC/FC money feed,
the user-behaviour feed, the order log, the device feed and the marks feed; ``lineitem`` plays the
ACT feed; ``customer`` holds the exclusion list. Every view is a projection over the scan, so
Catalyst prunes columns and pushes filters into parquet.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Transaction code booked for each event type (DC feed stand-in).
EVENT_CODE = {"click": "N7CP", "error": "ONN3", "purchase": "N7PR", "signup": "VF32", "view": "RJ53"}
# Marketing channels, indexed by user_id % 4.
CHANNELS = ("wechat", "weibo", "appstore", "huaweistore")
# ACT feed codes (status by line number % 4, product by supplier % 3, receiver by
# part % 3) and type by return flag.
ACT_STATUS = ("20", "22", "33", "44")
ACT_PRODUCT = ("95100", "95500", "99800")
ACT_RECEIVER = ("95100033", "95101233", "95101033")
ACT_TYPE = {"A": "kpp", "N": "kqp", "R": "kxp"}
ACT_DIR = {"O": "C", "F": "D"}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table, with the files that are there now."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _map(col: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr


def _pick(values: tuple, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def event_types_for(codes) -> list[str]:
    """Event types whose transaction code is in ``codes`` (inverse of ``EVENT_CODE``)."""
    return [t for t, c in EVENT_CODE.items() if c in set(codes)]


def props_k(props: str | Column = "props") -> Column:
    """``props`` is a JSON object text like ``{"k": 87}``; extract ``k`` as int (null if absent)."""
    col = F.col(props) if isinstance(props, str) else props
    return F.get_json_object(col, "$.k").try_cast("int")


def events_as_dc(events: DataFrame) -> DataFrame:
    """``events`` -> parsed DC records (strings, as the DC feed carries them) plus ``seq``/``ts``.

    act = user, ccy = user % 5, branch = props.k % 5, registration time in the feed's dotted format.
    """
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts"),
        F.col("user_id").cast("string").alias("act_nbr"),
        (F.col("user_id") % 5).cast("string").alias("ccy_cod"),
        (props_k() % 5).cast("string").alias("brn"),
        F.date_format("ts", "yyyy-MM-dd HH.mm.ss").alias("reg_tim"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("trs_amt"),
        _map(F.col("event_type"), EVENT_CODE).alias("code"),
    )


def events_as_fc(events: DataFrame) -> DataFrame:
    """``events`` -> FC records (act, ccy, unsigned amount, book direction ``+``/``-``)."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("act_nbr"),
        (F.col("user_id") % 5).cast("string").alias("ccy_cod"),
        F.col("value").cast("decimal(18,2)").cast("decimal(38,2)").alias("amt"),
        F.when(F.col("event_type").isin("purchase", "signup"), F.lit("+"))
        .otherwise(F.lit("-")).alias("dir"),
    )


def exclusion_list(customer: DataFrame) -> DataFrame:
    """Blacklisted ``(act_nbr, ccy_cod)`` pairs: customers with a negative balance."""
    return (customer.where(F.col("c_acctbal") < 0)
            .select(F.col("c_custkey").cast("string").alias("act_nbr"),
                    (F.col("c_nationkey") % 5).cast("string").alias("ccy_cod")))


def lineitem_as_act(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` -> ACT records (type, account, currency, time, amount, direction, product,
    status, receiver)."""
    return lineitem.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        _map(F.col("l_returnflag"), ACT_TYPE).alias("typ"),
        F.col("l_orderkey").cast("string").alias("act_nbr"),
        (F.col("l_partkey") % 5).cast("string").alias("ccy_nbr"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("reg_tim"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("decimal(38,2)").alias("amt"),
        _map(F.col("l_linestatus"), ACT_DIR).alias("dir"),
        _pick(ACT_PRODUCT, F.col("l_suppkey") % 3).alias("cod"),
        _pick(ACT_STATUS, F.col("l_linenumber") % 4).alias("sts"),
        _pick(ACT_RECEIVER, F.col("l_partkey") % 3).alias("rcv"),
    )


def events_as_marks(events: DataFrame) -> DataFrame:
    """``events`` -> marks feed: name = user, mark = value (exact cents), arrival = event_id."""
    return events.select(
        F.col("user_id").cast("string").alias("name"),
        F.col("value").cast("decimal(18,2)").alias("mark"),
        F.col("event_id").alias("seq"),
    )


def events_as_devices(events: DataFrame) -> DataFrame:
    """``events`` -> device readings: id = user, value, event time, arrival = event_id."""
    return events.select(
        F.col("user_id").cast("string").alias("id"),
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
    )


def events_as_orders(events: DataFrame, create_type: str = "signup",
                     pay_type: str = "purchase") -> DataFrame:
    """``events`` -> order log: order = user, create = signup, pay = purchase."""
    return (events.where(F.col("event_type").isin(create_type, pay_type))
            .select(F.col("user_id").alias("order_id"),
                    F.when(F.col("event_type") == create_type, F.lit("create"))
                    .otherwise(F.lit("pay")).alias("event_type"),
                    F.col("ts"),
                    F.col("event_id").alias("seq")))


def events_as_marketing(events: DataFrame) -> DataFrame:
    """``events`` -> marketing behaviour: channel by user, behaviour = event type, time."""
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("behavior"),
        _pick(CHANNELS, F.col("user_id") % 4).alias("channel"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
    )
