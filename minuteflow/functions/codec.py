"""Payload codecs: Base64 lines, audit headers and payload typing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the audit header format.
HEADER_VERSION = "01"
HEADER_MAGIC = "ABCDEF"
HEADER_LENGTH = 16
HEADER_BASE_MS = 1356998400000


def to_payload(df: DataFrame, cols: str | list[str], name: str = "payload") -> DataFrame:
    """Add a binary payload: one column cast to bytes, or several as a JSON object."""
    if isinstance(cols, str):
        payload = F.col(cols).cast("binary")
    else:
        payload = F.to_json(F.struct(*cols)).cast("binary")
    return df.withColumn(name, payload)


def encode_line(payload: Column) -> Column:
    """The stored line of a message: Base64 without the line breaks of MIME."""
    return F.translate(F.base64(payload), "\r\n", "")


def lenient_base64(line: Column) -> Column:
    """Decode Base64, skipping characters outside its alphabet.

    Accepts the URL-safe alphabet, ends at the first ``=`` and drops a lone
    last character, which carries less than one byte.
    """
    kept = F.regexp_replace(line, "[^A-Za-z0-9+/_=-]", "")
    kept = F.translate(F.regexp_replace(kept, "=.*$", ""), "-_", "+/")
    size = F.length(kept)
    kept = F.when(size % 4 == 1, F.substring(kept, F.lit(1), size - 1)).otherwise(kept)
    return F.try_to_binary(kept, F.lit("base64"))


def decode_lines(
    df: DataFrame, col: str = "value", name: str = "payload", lenient: bool = False
) -> DataFrame:
    """Add the decoded payload of each line and a ``corrupt`` flag.

    A line that is not valid Base64 is flagged. Its payload is NULL, or with
    ``lenient`` what remains after skipping the bad characters.
    """
    strict = F.try_to_binary(F.col(col), F.lit("base64"))
    payload = F.coalesce(strict, lenient_base64(F.col(col))) if lenient else strict
    return df.withColumn(name, payload).withColumn(
        "corrupt", F.col(col).isNotNull() & strict.isNull()
    )


def header(payload: Column, ts_ms: Column) -> Column:
    """The 16 header bytes: version, magic, time in ms, payload length."""
    return F.unhex(
        F.concat(
            F.lit(HEADER_VERSION + HEADER_MAGIC),
            F.lpad(F.hex(ts_ms.cast("long")), 16, "0"),
            F.lpad(F.hex(F.octet_length(payload).cast("long")), 8, "0"),
        )
    )


def with_header(payload: Column, ts_ms: Column) -> Column:
    return F.concat(header(payload, ts_ms), payload)


def attach_header(df: DataFrame, ts_ms: str, col: str = "payload") -> DataFrame:
    """Put an audit header with time ``ts_ms`` before each payload."""
    return df.withColumn(col, with_header(F.col(col), F.col(ts_ms)))


def header_time(payload: Column) -> Column:
    """The eight time bytes as a signed 64-bit number."""
    return F.conv(F.hex(F.substring(payload, 5, 8)), 16, -10).try_cast("long")


def has_header(payload: Column) -> Column:
    """True if the payload starts with a valid audit header.

    Bytes are compared as they are, in unsigned order; nothing is decoded.
    """

    def raw(digits: str) -> Column:
        return F.unhex(F.lit(digits))

    size = F.octet_length(payload)
    time = F.substring(payload, 5, 8)
    body_size = F.unhex(F.lpad(F.hex((size - HEADER_LENGTH).cast("long")), 8, "0"))
    checks = (
        (size >= HEADER_LENGTH)
        & (F.substring(payload, 1, 4) == raw(HEADER_VERSION + HEADER_MAGIC))
        & (time >= raw(f"{HEADER_BASE_MS:016X}"))
        & (time < raw("8000000000000000"))  # a set first bit means a negative time
        & (F.substring(payload, 13, 4) == body_size)
    )
    return F.coalesce(checks, F.lit(False))


def without_header(payload: Column) -> Column:
    size = F.octet_length(payload)
    body = F.substring(payload, F.lit(HEADER_LENGTH + 1), size)
    return F.when(has_header(payload), body).otherwise(payload)


def audit_ts(payload: Column) -> Column:
    """The header time in ms, or -1 if there is no valid header."""
    return F.when(has_header(payload), header_time(payload)).otherwise(F.lit(-1).cast("long"))


def strip_header(df: DataFrame, col: str = "payload") -> DataFrame:
    """Add ``audit_ts`` and drop a valid header; other payloads stay as they are."""
    return df.withColumn("audit_ts", audit_ts(F.col(col))).withColumn(
        col, without_header(F.col(col))
    )
