"""Batch reads of minute-directory streams."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from minuteflow.functions import codec, filenames
from minuteflow.operators.ranges import check_range, parse_group
from minuteflow.session import require_utc
from minuteflow.sources import layout, storage

POSITION_COLUMNS = [
    "topic", "stream_type", "cluster", "collector", "minute", "file_minute", "file_id",
    "file_dir", "file_name", "file_mtime", "file_path", "split_start",
]

_ENCODED = ' "<>\\^`{|}%#?[]'
_EMPTY_TEXT = T.StructType([T.StructField("value", T.StringType())])


def load_or_empty(
    spark: SparkSession, fmt: str, path: str, options: dict[str, str], schema=None
) -> DataFrame:
    """Load all files below a path; a path with no match gives no rows.

    ``_metadata`` stays the reader's own hidden column: predicates on it then
    drop whole files when Spark lists the input.
    """
    reader = spark.read.format(fmt).options(**options).option("recursiveFileLookup", "true")
    reader = reader.schema(schema) if schema is not None else reader
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        meta = (
            "struct<file_path:string,file_name:string,file_size:bigint,"
            "file_block_start:bigint,file_modification_time:timestamp>"
        )
        empty = spark.createDataFrame([], schema or _EMPTY_TEXT)
        return empty.withColumn("_metadata", F.lit(None).cast(meta))


def decoded(uri_part: Column) -> Column:
    """Undo the URI encoding of ``_metadata`` names; most have nothing to undo."""
    plain = F.replace(uri_part, F.lit("+"), F.lit("%2B"))
    return F.when(uri_part.contains("%"), F.try_url_decode(plain)).otherwise(uri_part)


def inner_path(base: str, encoded: bool = True) -> str:
    """The path of ``base`` as it appears inside file paths.

    ``_metadata.file_path`` is URI-encoded; the path of ``binaryFile`` is not.
    """
    inner = base.split("://", 1)[-1]
    inner = "/" + inner.split("/", 1)[-1].strip("/") + "/"
    return "".join(f"%{ord(c):02X}" if encoded and c in _ENCODED else c for c in inner)


def path_below(file_path: Column, inner: str) -> Column:
    """The part of a file's path below ``inner``, by plain string search."""
    begin = F.locate(inner, file_path) + len(inner)
    return F.substring(file_path, begin, F.length(file_path))


def in_minute_dirs(file_path: Column, inner: str, group: str | None = None) -> Column:
    """True for files below a minute directory that the group member owns.

    One pattern on the path alone, so Spark applies it to files when it lists
    them and it costs little where it runs again on rows.
    """
    minutes = "[0-5]\\d"
    if group is not None:
        number, total = parse_group(group)
        minutes = "|".join(f"{m:02d}" for m in range(number - 1, 60, total))
    day = r"\d{4}/(?:0[1-9]|1[0-2])/(?:0[1-9]|[12]\d|3[01])"
    return file_path.rlike(rf"\Q{inner}\E{day}/(?:[01]\d|2[0-3])/(?:{minutes})/")


def minute_of_dir(file_dir: Column) -> Column:
    return F.try_to_timestamp(F.substring(file_dir, 1, 16), F.lit(layout.MINUTE_DIR_FORMAT))


def _scan_root(spark, cluster, root, topic, stream_type, fmt, start, stop, group, options, schema):
    base = layout.stream_dir(storage.existing(spark, root), topic, stream_type)
    raw = load_or_empty(spark, fmt, layout.range_path(base, start, stop), options, schema)
    values = [c for c in raw.columns if c != "_metadata"]
    file_path, name = F.col("_metadata.file_path"), decoded(F.col("_metadata.file_name"))
    inner = inner_path(base)
    below = path_below(file_path, inner)
    dir_size = F.length(below) - F.length("_metadata.file_name") - 1
    file_dir = decoded(F.substring(below, F.lit(1), dir_size))
    committed = stream_type != "generic"
    null = F.lit(None)
    # The directories of the range are listed exactly, so only the layout is checked.
    out = raw.filter(in_minute_dirs(file_path, inner, group)).select(
        F.lit(topic).alias("topic"),
        F.lit(stream_type).alias("stream_type"),
        F.lit(cluster).alias("cluster"),
        (filenames.collector_of(name, topic) if committed else null.cast("string")).alias(
            "collector"
        ),
        minute_of_dir(below).alias("minute"),
        (filenames.file_minute_of(name) if committed else null.cast("timestamp")).alias(
            "file_minute"
        ),
        (filenames.file_id_of(name) if committed else null.cast("int")).alias("file_id"),
        file_dir.alias("file_dir"),
        name.alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
        file_path.alias("file_path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        *values,
    )
    return out


def read_minutes(
    spark: SparkSession,
    roots: layout.Roots,
    topic: str,
    stream_type: str = "local",
    fmt: str = "text",
    start: datetime | None = None,
    stop: datetime | None = None,
    group: str | None = None,
    options: dict[str, str] | None = None,
    schema=None,
) -> DataFrame:
    """Read ``<root>/<base>/<topic>/yyyy/MM/dd/HH/mm/**`` of every root.

    The range (both ends inclusive) limits the directories that are listed; the
    consumer group ``k/n`` limits the files that are opened. Names starting
    with ``_`` or ``.`` are skipped.
    """
    check_range(start, stop)
    require_utc(spark)
    frames = [
        _scan_root(
            spark, cluster, root, topic, stream_type, fmt, start, stop, group, options or {}, schema
        )
        for cluster, root in layout.named_roots(roots, stream_type).items()
    ]
    return reduce(DataFrame.unionByName, frames)


def decode_messages(lines: DataFrame, lenient: bool = False) -> DataFrame:
    """Base64 lines to payloads without audit header, plus ``audit_ts`` and ``corrupt``."""
    decoded = codec.decode_lines(lines, lenient=lenient).drop("value")
    return codec.strip_header(decoded)


def read_messages(spark: SparkSession, roots: layout.Roots, topic: str, **kwargs) -> DataFrame:
    """The message table of a stream: scan, Base64 decode and header strip."""
    return decode_messages(read_minutes(spark, roots, topic, fmt="text", **kwargs))


def read_sequence_values(
    spark: SparkSession,
    roots: layout.Roots,
    topic: str,
    stream_type: str = "generic",
    start: datetime | None = None,
    stop: datetime | None = None,
    key_class: str = "org.apache.hadoop.io.IntWritable",
) -> DataFrame:
    """Text values of old sequence files, without keys: ``topic, cluster, value``.

    Spark has no DataFrame reader for this format, so this one source goes
    through the Hadoop input format. The range still limits the directories.
    """
    check_range(start, stop)
    schema = T.StructType([T.StructField("value", T.StringType())])
    frames = []
    for cluster, root in layout.named_roots(roots, stream_type).items():
        base = layout.stream_dir(storage.qualify(spark, root), topic, stream_type)
        values = spark.sparkContext.newAPIHadoopFile(
            layout.range_path(base, start, stop),
            "org.apache.hadoop.mapreduce.lib.input.SequenceFileInputFormat",
            key_class,
            "org.apache.hadoop.io.Text",
            conf={"mapreduce.input.fileinputformat.input.dir.recursive": "true"},
        ).map(lambda pair: (pair[1],))
        frames.append(
            spark.createDataFrame(values, schema).select(
                F.lit(topic).alias("topic"), F.lit(cluster).alias("cluster"), "value"
            )
        )
    return reduce(DataFrame.unionByName, frames)
