"""Column-level functions: parsing, classification, hashing, time conversion."""

from .parse import (classify_dc, epoch_to_ts, parse_envelope, reg_date, reg_time, str_to_ts,
                    to_money, uuid_nodash)
from .hashing import poly_hash

__all__ = ["classify_dc", "epoch_to_ts", "parse_envelope", "poly_hash", "reg_date", "reg_time",
           "str_to_ts", "to_money", "uuid_nodash"]
