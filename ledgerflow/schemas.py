"""Record schemas of the feeds and entities (all DC/FC/ACT message fields arrive as strings)."""

from pyspark.sql import types as T

S = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, S, True) for n in names])


# Message field names as they appear on the wire (fixed values of the message formats).
DC_DATA_FIELDS = ("BTSACTNBR", "BTSCCYNBR", "BTSBRNGLG", "BTSREGTIM", "BTSTRSAMT", "BTSONLBAL",
                  "BTSTXTC2G", "BTSTRSDIR", "BTSRCDVER")
FC_DATA_FIELDS = ("ACT_NBR", "ACT_NAM", "BUS_NBR", "BAC_DAT", "CCY_NBR", "TRX_AMT", "BOK_DIR",
                  "VAL_DAT", "BUS_SYS", "PRE_FLG", "REA_FLG", "RPT_BRN", "CAN_FLG", "BUS_SEQ")
ACT_DATA_FIELDS = ("type", "ACTNBR", "CCYNBR", "BRNGLG", "REGTIM", "TRSAMT", "TRSDIR", "PRDCOD",
                   "RCVEAC", "PRCSTS")

DC_DATA = _strings(*DC_DATA_FIELDS)
FC_DATA = _strings(*FC_DATA_FIELDS)
ACT_DATA = _strings(*ACT_DATA_FIELDS)

# Envelope with ``data`` read as raw text: an object and an escaped JSON string both land here and
# are parsed in a second step (see functions.parse.parse_envelope).
ENVELOPE_RAW = T.StructType([
    T.StructField("type", S, True),
    T.StructField("send_time", S, True),
    T.StructField("data", S, True),
])

USER_BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType(), True),
    T.StructField("item_id", T.LongType(), True),
    T.StructField("category_id", T.IntegerType(), True),
    T.StructField("behavior", S, True),
    T.StructField("timestamp", T.LongType(), True),
])

ORDER_EVENT = T.StructType([
    T.StructField("order_id", T.LongType(), True),
    T.StructField("event_type", S, True),
    T.StructField("tx_id", S, True),
    T.StructField("event_time", T.LongType(), True),
])

DEVICE = T.StructType([
    T.StructField("id", S, True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("ts_ms", T.LongType(), True),
])

MARK = T.StructType([
    T.StructField("name", S, True),
    T.StructField("mark", T.DecimalType(18, 2), True),
])

MONEY = T.DecimalType(38, 2)
