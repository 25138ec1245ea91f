"""Parsing and scalar functions (all JVM-side Spark expressions, no Python UDFs).

Parsing is permissive: malformed text yields nulls (``try_*`` functions, ``from_json`` PERMISSIVE),
and :func:`with_rejects` splits such rows off instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ENVELOPE_RAW, MONEY

# Transaction codes of the DC feed and the direction they book.
OUT_CODES = ("N7CP", "ONN3")
IN_CODES = ("N7PR",)
DIR_OUT = "OUT"
DIR_IN = "IN"

# Timestamp text formats of the feeds.
REG_DATE_FORMAT = "yyyy-MM-dd"
REG_TIME_FORMAT = "yyyy-MM-dd HH.mm.ss"
STR_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_envelope(df: DataFrame, value_col: str, data_schema: T.StructType,
                   rename: dict[str, str] | None = None, keep: Iterable[str] = ()) -> DataFrame:
    """JSON envelope ``{type, send_time, data:{...}}`` -> one column per ``data`` field.

    ``data`` may be a nested object or an escaped JSON string: the envelope is read with ``data``
    as text (Spark keeps the raw JSON of an object for a string field) and parsed in a second step.
    Both are parsed once a record; only the fields in ``rename`` (or all of ``data_schema``) are kept.
    """
    keep = list(keep)
    env = F.from_json(_c(value_col), ENVELOPE_RAW)
    fields = rename or {f.name: f.name for f in data_schema.fields}
    # each parsed struct is a column of its own, so that a record is parsed once and not once a field
    outer = df.select(*keep, env.alias("_env"))
    inner = outer.select(*keep, F.col("_env.type").alias("msg_type"),
                         F.col("_env.send_time").alias("send_time"),
                         F.from_json(F.col("_env.data"), data_schema).alias("_data"))
    return inner.select(*keep, "msg_type", "send_time",
                        *[F.col("_data").getField(src).alias(dst) for src, dst in fields.items()])


def reg_date(s: str | Column) -> Column:
    """``yyyy-MM-dd`` prefix of a registration time -> date text (null when unparsable)."""
    ts = F.try_to_timestamp(F.substring(_c(s), 1, 10), F.lit(REG_DATE_FORMAT))
    return F.date_format(ts, REG_DATE_FORMAT)


def reg_time(s: str | Column) -> Column:
    """``yyyy-MM-dd HH.mm.ss`` (dotted time) -> ``HH:mm`` (null when unparsable)."""
    ts = F.try_to_timestamp(_c(s), F.lit(REG_TIME_FORMAT))
    return F.date_format(ts, "HH:mm")


def str_to_ts(s: str | Column, fmt: str = STR_DATE_FORMAT) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> timestamp (null when unparsable)."""
    return F.try_to_timestamp(_c(s), F.lit(fmt))


def to_money(s: str | Column) -> Column:
    """Decimal text -> DECIMAL(38,2); null when not a number (ANSI-safe)."""
    return F.expr(f"try_cast({_sql(s)} AS DECIMAL(38,2))") if isinstance(s, str) else \
        s.try_cast(MONEY)


def _sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def epoch_to_ts(c: str | Column, unit: str) -> Column:
    """Epoch number -> TIMESTAMP; ``unit`` is ``'s'``, ``'ms'`` or ``'us'`` and must be explicit."""
    col = _c(c)
    if unit == "s":
        return F.timestamp_seconds(col)
    if unit == "ms":
        return F.timestamp_millis(col)
    if unit == "us":
        return F.timestamp_micros(col)
    raise ValueError(f"unknown epoch unit {unit!r}")


def uuid_nodash() -> Column:
    """Random UUID without dashes (non-deterministic; sinks use deterministic keys instead)."""
    return F.regexp_replace(F.expr("uuid()"), "-", "")


def classify_dc(df: DataFrame, code_col: str = "code", amt_col: str = "trs_amt",
                reg_col: str = "reg_tim", out_codes=OUT_CODES, in_codes=IN_CODES) -> DataFrame:
    """Direction and signed amount by transaction code, plus date and minute of registration.

    Out codes book ``-abs(amt)``, in codes ``+abs(amt)``; any other code gets a null direction and
    a zero amount (the filter :func:`recognised` drops those rows).
    """
    code = F.col(code_col)
    amt = to_money(amt_col) if dict(df.dtypes).get(amt_col) == "string" else \
        F.col(amt_col).cast(MONEY)
    direction = (F.when(code.isin(*out_codes), F.lit(DIR_OUT))
                 .when(code.isin(*in_codes), F.lit(DIR_IN)))
    signed = (F.when(code.isin(*out_codes), -F.abs(amt))
              .when(code.isin(*in_codes), F.abs(amt))
              .otherwise(F.lit(0).cast(MONEY)))
    return df.select(
        "*",
        direction.alias("direction"),
        amt.alias("amt"),
        signed.cast(MONEY).alias("signed_amt"),
        reg_date(reg_col).alias("date"),
        reg_time(reg_col).alias("time"),
    )


def recognised(df: DataFrame) -> DataFrame:
    """Keep rows with a recognised transaction code (direction not null)."""
    return df.where(F.col("direction").isNotNull())


def with_rejects(df: DataFrame, required: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows whose ``required`` columns all parsed from those where one is null."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    return df.where(ok), df.where(~ok)


# ------------------------------------------------------------------ feed parsers
DC_RENAME = {"BTSACTNBR": "act_nbr", "BTSCCYNBR": "ccy_cod", "BTSBRNGLG": "brn",
             "BTSREGTIM": "reg_tim", "BTSTRSAMT": "trs_amt", "BTSONLBAL": "onl_bal",
             "BTSTXTC2G": "code", "BTSTRSDIR": "trs_dir", "BTSRCDVER": "rcd_ver"}
FC_RENAME = {"ACT_NBR": "act_nbr", "CCY_NBR": "ccy_cod", "TRX_AMT": "trx_amt", "BOK_DIR": "dir"}
ACT_RENAME = {"type": "typ", "ACTNBR": "act_nbr", "CCYNBR": "ccy_nbr", "BRNGLG": "brn",
              "REGTIM": "reg_tim", "TRSAMT": "trs_amt", "TRSDIR": "dir", "PRDCOD": "cod",
              "RCVEAC": "rcv", "PRCSTS": "sts"}


def parse_dc(lines: DataFrame, value_col: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """DC message lines -> DC records (all text, as on the wire)."""
    from ..schemas import DC_DATA
    return parse_envelope(lines, value_col, DC_DATA, DC_RENAME, keep)


def parse_fc(lines: DataFrame, value_col: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """FC message lines -> ``(act_nbr, ccy_cod, amt, dir)``; amount as DECIMAL(38,2)."""
    from ..schemas import FC_DATA
    p = parse_envelope(lines, value_col, FC_DATA, FC_RENAME, keep)
    return p.select(*keep, "act_nbr", "ccy_cod", to_money("trx_amt").alias("amt"), "dir")


def parse_act(lines: DataFrame, value_col: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """ACT message lines -> ACT records; ``reg_tim`` epoch ms as long, amount as decimal."""
    from ..schemas import ACT_DATA
    p = parse_envelope(lines, value_col, ACT_DATA, ACT_RENAME, keep)
    return p.select(*keep, "typ", "act_nbr", "ccy_nbr", "brn",
                    F.col("reg_tim").try_cast("bigint").alias("reg_tim"),
                    to_money("trs_amt").alias("amt"), "dir", "cod", "sts", "rcv")


def parse_devices(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Device lines ``id,value,epoch ms`` -> ``id, value, ts``."""
    from ..schemas import DEVICE
    d = parse_csv_lines(lines, DEVICE, value_col)
    return d.select("id", "value", epoch_to_ts("ts_ms", "ms").alias("ts"))


def parse_csv_lines(lines: DataFrame, schema: T.StructType, value_col: str = "value",
                    trim: bool = True) -> DataFrame:
    """Comma-separated text lines -> typed columns in schema order (``from_csv``, permissive)."""
    opts = {"ignoreLeadingWhiteSpace": str(trim).lower(),
            "ignoreTrailingWhiteSpace": str(trim).lower(), "mode": "PERMISSIVE"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return lines.select(F.from_csv(F.col(value_col), ddl, opts)
                        .alias("_r")).select("_r.*")
