"""Queue messages: the binary envelope of the collectors. Offset ranges are read with a source's start and end options.

Envelope, read from the end: mark byte 0xFF, data length, then backwards
``data | compression | lines | raw length | system\\x01ip\\x01path``. Integers are
big-endian with the sign bit flipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import times
from ..operators.once import once

# Fixed values of the envelope format.
COMPRESS_FROM = 1024 * 1024
PLAIN, LZ4 = 0, 1
PULL_ERROR = "mqPullError"
SIGN_BIT = 2147483648


def _int_at(body: Column, position: Column) -> Column:
    """Decode the 4-byte integer that starts at a 1-based position."""
    return F.conv(F.hex(F.substring(body, position, F.lit(4))), 16, 10).cast("bigint") - SIGN_BIT


def _int_bytes(value: Column) -> Column:
    return F.unhex(F.lpad(F.hex(value.cast("bigint") + SIGN_BIT), 8, "0"))


@F.pandas_udf(T.BinaryType())
def _unpack_lz4(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    import pyarrow as pa

    codec = pa.Codec("lz4_raw")

    def one(data, size):
        if data is None or pd.isna(size):
            return None
        try:
            return codec.decompress(data, decompressed_size=int(size)).to_pybytes()
        except Exception:  # a damaged body is a reject, never a failed task
            return None

    for data, size in parts:
        yield pd.Series([one(d, s) for d, s in zip(data, size)], dtype=object)


@F.pandas_udf(T.BinaryType())
def _pack_lz4(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    import pyarrow as pa

    codec = pa.Codec("lz4_raw")
    for data in parts:
        yield pd.Series([codec.compress(d, asbytes=True) for d in data], dtype=object)


def envelope_decode(df: DataFrame, body: str = "body", lz4: bool = True) -> DataFrame:
    """Add data_system, ip, file_path, line_count, message_body and ok.

    ``lz4=False`` says that no body is compressed, so that no Python runs at all.
    """
    b = F.col(body)
    total = F.octet_length(b)
    marked = (total >= 1) & (F.hex(F.substring(b, -1, 1)) == "FF")
    length = F.when(total >= 17, _int_at(b, total - 4))
    sound = length.between(0, total - 17)
    head = once(df, {"_marked": marked, "_sound": marked & F.coalesce(sound, F.lit(False)),
                     "_len": F.when(marked & sound, length).cast("int")})
    start = F.col("_len") + 1
    names = F.split(F.substring(b, start + 12, total - F.col("_len") - 17).cast("string"), "\x01")
    split = head.select("*", F.when(F.col("_sound"), F.substring(b, F.lit(1), F.col("_len"))).alias("_data"),
                        F.when(F.col("_sound"), _int_at(b, start)).alias("_kind"),
                        F.when(F.col("_sound"), _int_at(b, start + 4)).alias("_lines"),
                        F.when(F.col("_sound"), _int_at(b, start + 8)).alias("_raw"),
                        F.when(F.col("_sound"), names).alias("_names"))
    plain = F.col("_kind") == PLAIN
    if lz4:
        packed = F.when(F.col("_kind") == LZ4, F.col("_data"))
        # NULL goes in for every uncompressed row, so their bytes never reach Python
        unpacked = _unpack_lz4(packed, F.when(F.col("_kind") == LZ4, F.col("_raw")))
    else:
        unpacked = F.lit(None).cast("binary")
    whole = ~F.col("_marked")
    text = lambda i: F.coalesce(F.try_element_at("_names", F.lit(i)), F.lit(""))
    out = split.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.when(whole, F.lit("")).otherwise(text(1)).alias("data_system"),
        F.when(whole, F.lit("")).otherwise(text(2)).alias("ip"),
        F.when(whole, F.lit("")).otherwise(text(3)).alias("file_path"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("_lines", F.lit(0))).cast("bigint").alias("line_count"),
        F.when(whole, b).when(plain, F.col("_data")).otherwise(unpacked).alias("message_body"))
    return out.withColumn("ok", F.col("message_body").isNotNull())


def envelope_encode(df: DataFrame, data: str = "message_body", out: str = "body",
                    compress_from: int | None = None) -> DataFrame:
    """Inverse of the decoder; bodies from ``compress_from`` bytes on are compressed."""
    d = F.col(data)
    names = F.concat_ws("\x01", "data_system", "ip", F.coalesce(F.col("file_path"), F.lit("")))
    if compress_from is None:
        payload, kind = d, F.lit(PLAIN)
    else:
        big = F.octet_length(d) >= compress_from
        payload = F.when(big, _pack_lz4(F.when(big, d).otherwise(F.lit(b"")))).otherwise(d)
        kind = F.when(big, F.lit(LZ4)).otherwise(F.lit(PLAIN))
    staged = df.select("*", payload.alias("_payload"), kind.alias("_kind"))
    body = F.concat(F.col("_payload"), _int_bytes(F.col("_kind")), _int_bytes(F.col("line_count")),
                    _int_bytes(F.octet_length(d)), names.cast("binary"),
                    _int_bytes(F.octet_length("_payload")), F.unhex(F.lit("FF")))
    return once(staged, {out: body}, [c for c in df.columns if c != out])


def message_lines(df: DataFrame, pulled_at: Column | None = None, lz4: bool = True) -> DataFrame:
    """Lines of all messages with the names of their envelope.

    A body that cannot be decoded becomes one line tagged as pull error; lines
    without a data system (metric traffic) are kept apart by ``drop_unnamed``.
    """
    decoded = envelope_decode(df.where(F.col("body").isNotNull()), lz4=lz4)
    stamp = F.lit("") if pulled_at is None else F.concat(pulled_at.cast("string"), F.lit(":"))
    raw = F.concat(stamp, F.col("body").cast("string"))
    text = F.regexp_replace(F.col("message_body").cast("string"), "\n+$", "")
    lines = F.when(F.col("ok"), F.split(text, "\n")).otherwise(F.array(raw))
    kept = [F.col(f"`{c}`") for c in df.columns if c != "body"]
    return decoded.select(
        *kept, F.when(F.col("ok"), F.col("data_system")).otherwise(F.lit(PULL_ERROR)).alias("data_system"),
        "ip", "file_path", F.when(F.col("ok"), F.col("line_count")).otherwise(F.lit(0)).alias("line_count"),
        F.size(lines).alias("lines_in_message"), F.posexplode(lines).alias("line_no", "line"))


def drop_unnamed(lines: DataFrame) -> DataFrame:
    return lines.where(F.col("data_system") != "")


def metric_lines(lines: DataFrame) -> DataFrame:
    """Metric traffic: lines without a data system whose value is not zero."""
    value = F.get_json_object("line", "$.value").try_cast("double")
    return lines.where((F.col("data_system") == "") & (F.coalesce(value, F.lit(1.0)) != 0))
