"""Payload helpers: byte lengths and the response body after the protocol headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_END = "\r\n\r\n"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def byte_length(b: Column | str) -> Column:
    return F.octet_length(_c(b)).cast("bigint")


def response_body(raw: Column | str) -> Column:
    """Bytes after the first blank line (CRLF CRLF); the whole payload if there is none.

    Decoding as ISO-8859-1 maps each byte to one char, so the char offset of the
    separator is its byte offset and non-UTF-8 bodies pass through unchanged.
    """
    r = _c(raw)
    pos = F.instr(F.decode(r, "ISO-8859-1"), HEADER_END)
    return F.when(pos > 0, F.substr(r, pos + 4)).otherwise(r)
