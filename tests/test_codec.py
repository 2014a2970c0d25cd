import struct
from base64 import b64encode

import pytest
from pyspark.sql import functions as F

from minuteflow.functions import codec

NOW = 1704067200123


def framed(payload: bytes, version=1, magic=b"\xab\xcd\xef", ms=NOW, size=None) -> bytes:
    return struct.pack(">B3sqi", version, magic, ms, len(payload) if size is None else size) + payload


def binary(spark, rows):
    return spark.createDataFrame([(i, bytearray(r)) for i, r in enumerate(rows)], "id int, payload binary")


def test_attach_matches_byte_layout(spark):
    payloads = [b"", b"hello", bytes(range(256)), b"x" * 5000]
    df = binary(spark, payloads).withColumn("ms", F.lit(NOW))
    out = codec.attach_header(df, "ms").orderBy("id").collect()
    assert [bytes(r.payload) for r in out] == [framed(p) for p in payloads]


@pytest.mark.parametrize(
    "data, ms",
    [
        (framed(b"hello"), NOW),
        (framed(b""), NOW),
        (framed(b"hello", version=10), -1),
        (framed(b"hello", magic=b"\x01\x02\x03"), -1),
        (framed(b"hello", ms=1262304000000), -1),
        (framed(b"hello", ms=1356998400000), 1356998400000),
        (framed(b"hello", ms=1356998399999), -1),
        (framed(b"hello", ms=-5), -1),
        (framed(b"hello", size=3), -1),
        (framed(b"hello", size=-1), -1),
        (b"short", -1),
        (b"", -1),
        (b"plain text that is longer than the header", -1),
    ],
)
def test_strip_header(spark, data, ms):
    row = codec.strip_header(binary(spark, [data])).first()
    assert row.audit_ts == ms
    assert bytes(row.payload) == (data[16:] if ms >= 0 else data)


def test_lines_have_no_breaks(spark):
    long = bytes(range(256)) * 4
    line = binary(spark, [long]).select(codec.encode_line(F.col("payload")).alias("value"))
    assert line.first().value == b64encode(long).decode()


def test_decode_flags_bad_lines(spark):
    good = b64encode(b"some message").decode()
    rows = [good, "*" + good, good[:4] + "\t!" + good[4:], "####", "", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, value string")
    strict = codec.decode_lines(df).orderBy("id").collect()
    assert [r.corrupt for r in strict] == [False, True, True, True, False, False]
    assert bytes(strict[0].payload) == b"some message" and strict[1].payload is None
    lenient = codec.decode_lines(df, lenient=True).orderBy("id").collect()
    assert [bytes(r.payload) for r in lenient[:4]] == [b"some message"] * 3 + [b""]


def test_lenient_url_safe_and_tail(spark):
    data = bytes([251, 255, 254, 1])
    url = b64encode(data).decode().replace("+", "-").replace("/", "_")
    rows = [url, url.rstrip("="), "QUJD" + "R", "QUJD=RUZH"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, value string")
    out = [bytes(r.payload) for r in codec.decode_lines(df, lenient=True).orderBy("id").collect()]
    assert out == [data, data, b"ABC", b"ABC"]


def test_payload_forms(spark):
    df = spark.createDataFrame([("a", 1)], "s string, n int")
    assert bytes(codec.to_payload(df, "s").first().payload) == b"a"
    assert bytes(codec.to_payload(df, ["s", "n"]).first().payload) == b'{"s":"a","n":1}'
