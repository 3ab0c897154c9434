"""Encoders and decoders for record formats used by the stream jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The event alphabet of the state machine, in ordinal order.
EVENT_TYPES = ["a", "b", "c", "d", "e", "f", "g"]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_to_ipv4(ip: Column | str) -> Column:
    """32-bit int (signed) to dotted quad, most significant byte first."""
    v = _c(ip).cast("int")
    octets = [F.shiftrightunsigned(v, s).bitwiseAND(F.lit(255)).cast("string")
              for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def alert_text(ip: Column | str, state: Column | str, event: Column | str) -> Column:
    """``ALERT <ip> : <state> -> <event>``."""
    return F.concat(F.lit("ALERT "), int_to_ipv4(ip), F.lit(" : "), _c(state),
                    F.lit(" -> "), _c(event))


def _swapped(hex8: Column) -> Column:
    """The four bytes of eight hex digits in reverse order (``reverse`` would
    take binary for text and misplace bytes of 0x80 and more)."""
    return F.concat(*[F.substring(hex8, at, 2) for at in (7, 5, 3, 1)])


def _le_int(b: Column, pos: int) -> Column:
    """Signed little-endian 32-bit int at 1-based byte ``pos`` of a binary."""
    unsigned = F.conv(_swapped(F.hex(F.substring(b, pos, 4))), 16, 10).cast("long")
    return F.when(unsigned > F.lit(2**31 - 1), unsigned - F.lit(2**32)).otherwise(unsigned).cast("int")


def decode_event(value: Column | str) -> Column:
    """8-byte value -> struct(address int, type string)."""
    b = _c(value)
    ordinal = _le_int(b, 5)
    etype = F.element_at(F.array(*[F.lit(t) for t in EVENT_TYPES]), ordinal + 1)
    return F.struct(_le_int(b, 1).alias("address"), etype.alias("type"))


def _le_bytes(v: Column) -> Column:
    masked = v.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.unhex(_swapped(F.lpad(F.hex(masked), 8, "0")))


def encode_event(address: Column | str, etype: Column | str) -> Column:
    """Inverse of :func:`decode_event`: two little-endian ints."""
    ordinal = F.array_position(F.array(*[F.lit(t) for t in EVENT_TYPES]), _c(etype)) - 1
    return F.concat(_le_bytes(_c(address)), _le_bytes(ordinal))


def parse_tuple_text(value: Column | str, types: list[str]) -> Column:
    """``"(a,b,c)"`` -> struct of typed fields ``_1.._n``."""
    v = _c(value)
    inner = F.regexp_replace(F.regexp_replace(v, r"^\(", ""), r"\)$", "")
    parts = F.split(inner, ",")
    return F.struct(*[F.trim(F.element_at(parts, i + 1)).cast(t).alias(f"_{i + 1}")
                      for i, t in enumerate(types)])
