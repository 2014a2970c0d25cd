"""Names of collector files and committed files, and their columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed format of a collector file: <stream>-yyyy-MM-dd-HH-mm_NNNNN, and of its
# committed copy: <collector>-<collector file>.<ext>.
FILE_MINUTE_FORMAT = "yyyy-MM-dd-HH-mm"
NAME_PATTERN = r"^(.+)-(\d{4}-\d{2}-\d{2}-\d{2}-\d{2})_(\d+)(?:\.(\w+))?$"


_MINUTE_SIZE = 16  # characters of a printed file minute


def _tail(name: Column) -> Column:
    """What follows the last underscore: the id and an extension, if any."""
    return F.substring_index(name, "_", -1)


def file_minute_of(name: Column) -> Column:
    """The creation minute in a file name, or NULL.

    These three take well-formed names apart by position. They run on every
    row of a scan, so they use no patterns; ``parse_file_names`` is strict.
    """
    begin = F.length(name) - F.length(_tail(name)) - _MINUTE_SIZE
    return F.try_to_timestamp(
        F.substring(name, begin, F.lit(_MINUTE_SIZE)), F.lit(FILE_MINUTE_FORMAT)
    )


def file_id_of(name: Column) -> Column:
    return F.substring_index(_tail(name), ".", 1).try_cast("int")


def collector_of(name: Column, stream: str) -> Column:
    """The collector in front of the stream name, or NULL."""
    rest = F.length(name) - F.length(_tail(name)) - _MINUTE_SIZE - 1 - len(f"-{stream}-")
    collector = F.substring(name, F.lit(1), rest)
    is_stream = F.substring(name, rest + 1, F.lit(len(stream) + 2)) == f"-{stream}-"
    return F.when((rest > 0) & is_stream, collector)


def parse_file_names(df: DataFrame, col: str, stream: str | None = None) -> DataFrame:
    """Add ``stream, file_minute, file_id, collector, ext, valid``.

    Without ``stream`` the names are collector files. With it (the column that
    holds the stream name) they are committed files, which need a collector in
    front and an extension. Streams and collectors may contain ``-``.
    """
    name = F.col(col)
    parts = {
        "prefix": F.nullif(F.regexp_extract(name, NAME_PATTERN, 1), F.lit("")),
        "file_minute": F.try_to_timestamp(
            F.regexp_extract(name, NAME_PATTERN, 2), F.lit(FILE_MINUTE_FORMAT)
        ),
        "file_id": F.regexp_extract(name, NAME_PATTERN, 3).try_cast("int"),
        "ext": F.nullif(F.regexp_extract(name, NAME_PATTERN, 4), F.lit("")),
    }
    out = df.withColumn("_name", F.struct(*[v.alias(k) for k, v in parts.items()]))
    prefix = F.col("_name.prefix")
    dated = F.col("_name.file_minute").isNotNull() & F.col("_name.file_id").isNotNull()
    if stream is None:
        valid = dated & prefix.isNotNull() & F.col("_name.ext").isNull()
        stream_col, collector = prefix, F.lit(None).cast("string")
    else:
        size = F.length(prefix) - F.length(stream) - 1
        ends = prefix.endswith(F.concat(F.lit("-"), F.col(stream)))
        collector = F.when((size > 0) & ends, F.substring(prefix, F.lit(1), size))
        valid = dated & collector.isNotNull() & F.col("_name.ext").isNotNull()
        stream_col = F.col(stream)
    fields = {
        "stream": stream_col,
        "file_minute": F.col("_name.file_minute"),
        "file_id": F.col("_name.file_id"),
        "collector": collector,
        "ext": F.col("_name.ext"),
    }
    out = out.withColumn("valid", F.coalesce(valid, F.lit(False)))
    out = out.withColumns({k: F.when(F.col("valid"), v) for k, v in fields.items()})
    return out.drop("_name")


def collector_file_name(stream: Column, file_minute: Column, file_id: Column) -> Column:
    """Print a collector file name."""
    return F.concat(
        stream,
        F.lit("-"),
        F.date_format(file_minute, FILE_MINUTE_FORMAT),
        F.lit("_"),
        F.format_string("%05d", file_id),
    )


def committed_file_name(collector: Column, collector_file: Column, ext: str = "gz") -> Column:
    """Print the name a collector file gets when it is committed."""
    return F.concat(collector, F.lit("-"), collector_file, F.lit(f".{ext}"))
