"""WARC fixity audit: Merkle trees over record hashes and ordered offset ranges.

Each replica of a set of archives is hashed record by record. Records that start
in the same 64 KiB of an archive make a node, whose digest covers their places
and digests in order; 256 nodes side by side make the next one, up to 1 TiB, then
the archive, a folder of archives, and the replica's root. Nodes are places, not
counts, so a lost record leaves all other nodes alone. If the roots agree, so do
the replicas; otherwise only children of nodes that differ are looked at, down
to the records.

A node's children are bounded by its range (at most one record a byte, 256
nodes), so no task collects an archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from minuteflow.llm.common import kept, running_sums

ARCHIVE_BYTES = 1 << 30
FOLDERS = 256
# Bits of the place that each step up drops: 64 KiB, 16 MiB, 4 GiB, 1 TiB, the archive.
STEPS = (16, 8, 8, 8, 63)
CAPTURED = "2024-01-01T00:00:00Z"


def warc_record(page_id: Column, url: Column, payload: Column) -> Column:
    """A page as the text of a WARC record; nulls are empty, line ends in the address go."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        text(page_id),
        F.lit(f">\r\nWARC-Date: {CAPTURED}\r\nWARC-Target-URI: "),
        F.translate(text(url), "\r\n", ""),
        F.lit("\r\nContent-Length: "),
        F.octet_length(text(payload)).cast("string"),
        F.lit("\r\n\r\n"),
        text(payload),
        F.lit("\r\n\r\n"),
    )


def digest(record: Column) -> Column:
    """SHA-256 of a record's bytes, as 32 bytes; null for a record that is not there."""
    return F.unhex(F.sha2(record.cast("binary"), 256))


def laid_out(
    records: DataFrame, order: list[str], archive_bytes: int = ARCHIVE_BYTES, prefix: str = "pages-"
) -> DataFrame:
    """``records`` with the ``archive`` and the place ``start`` where each is written.

    Records of ``length`` bytes follow each other in ``order``; a new archive
    begins with the first record at or after every ``archive_bytes``. Repeated
    rows get places of their own.
    """
    tied = records.withColumn("tie", F.monotonically_increasing_id())
    summed = running_sums(tied, [*order, "tie"], ["length"], "layout").drop("tie")
    number = F.floor(F.col("length_before") / archive_bytes)
    numbered = summed.withColumn("number", number)
    # One row per archive.
    firsts = numbered.groupBy(F.col("number").alias("first_number")).agg(
        F.min("length_before").alias("first_place")
    )
    return numbered.join(firsts, F.col("number") == F.col("first_number")).select(
        *records.columns,
        F.concat(F.lit(prefix), F.col("number").cast("string"), F.lit(".warc")).alias("archive"),
        (F.col("length_before") - F.col("first_place")).alias("start"),
    )


def _leaves(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row per replica and place.

    A place that a replica claims with different bytes is contested: its digest
    carries the replica's number, so it differs from the other replica's.
    """
    columns = ["archive", "start", "length", "digest"]
    both = first.select(F.lit(0).alias("side"), *columns).unionByName(
        second.select(F.lit(1).alias("side"), *columns)
    )
    placed = both.where("archive is not null and start is not null and digest is not null")
    places = placed.groupBy("side", "archive", F.col("start").alias("at")).agg(
        F.min("digest").alias("least"),
        F.max("digest").alias("digest"),
        F.max("length").alias("length"),
    )
    contested = F.col("least") != F.col("digest")
    own = F.concat(F.col("side").cast("string").cast("binary"), F.col("digest"))
    return places.select(
        "side",
        "archive",
        "at",
        "length",
        F.when(contested, F.unhex(F.sha2(own, 256))).otherwise(F.col("digest")).alias("digest"),
        contested.alias("contested"),
    )


def _above(level: int) -> tuple[Column, Column]:
    """Name and place of the node above a node of ``level``."""
    if level < len(STEPS):
        return F.col("archive"), F.shiftright("at", STEPS[level])
    if level == len(STEPS):
        folder = F.pmod(F.xxhash64("archive"), F.lit(FOLDERS))
        return folder.cast("string"), F.lit(0).cast("long")
    return F.lit(""), F.lit(0).cast("long")


TOP = len(STEPS) + 2


def _nodes(children: DataFrame, level: int) -> DataFrame:
    """The nodes above those of ``level``: digests of their children's names, places and digests."""
    name, at = _above(level)
    one = F.concat(
        F.col("archive").cast("binary"),
        F.lit(":").cast("binary"),
        F.col("at").cast("string").cast("binary"),
        F.lit(":").cast("binary"),
        F.col("digest"),
    )
    parts = F.transform(
        F.sort_array(F.collect_list(F.struct("archive", "at", one.alias("one")))),
        lambda c: F.hex(c["one"]),
    )
    return children.groupBy("side", name.alias("above"), at.alias("above_at")).agg(
        F.unhex(F.sha2(F.array_join(parts, ",").cast("binary"), 256)).alias("digest")
    ).select("side", F.col("above").alias("archive"), F.col("above_at").alias("at"), "digest")


def trees(first: DataFrame, second: DataFrame) -> list[DataFrame]:
    """The levels of both replicas' trees, from records to roots, each stored once."""
    levels = [kept(_leaves(first, second), "tree-0")]
    for level in range(TOP):
        levels.append(kept(_nodes(levels[-1], level), f"tree-{level + 1}"))
    return levels


def _differing(rows: DataFrame, *columns: str) -> DataFrame:
    """Nodes that the replicas do not share, with each replica's ``columns``."""
    sides = [
        F.max(F.when(F.col("side") == side, F.col(c))).alias(f"{c}_{side}")
        for c in ("digest", *columns)
        for side in (0, 1)
    ]
    return rows.groupBy("archive", "at").agg(*sides).where(
        ~F.col("digest_0").eqNullSafe(F.col("digest_1"))
    )


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Where two replicas differ: ``archive``, ``start``, lengths, digests and ``status``.

    Both have ``archive``, ``start``, ``length`` and ``digest`` (see ``digest``)
    per record; further columns are ignored. ``status`` is ``altered``,
    ``missing`` (only in ``first``), ``extra`` (only in ``second``),
    ``contested`` (a replica has different bytes for one place, whatever the
    other has; its digests are not those of one record) or ``unplaced`` (no archive or no start; one row per record).
    Repeated equal rows count once. A record without a digest is not there.
    Equal replicas, and two empty ones, give no rows. What reaches the driver
    is the roots.
    """
    levels = trees(first, second)
    roots = {r.side: bytes(r.digest) for r in levels[-1].collect()}
    if roots.get(0) == roots.get(1):
        found = levels[0].limit(0)
    else:
        nodes = _differing(levels[-1]).select("archive", "at")
        for level in range(TOP - 1, -1, -1):
            name, at = _above(level)
            above = nodes.select(F.col("archive").alias("above"), F.col("at").alias("above_at"))
            branch = levels[level].join(
                above, (name == F.col("above")) & (at == F.col("above_at")), "left_semi"
            )
            if level:
                nodes = _differing(branch).select("archive", "at")
        found = branch
    status = (
        F.when(F.coalesce(F.greatest("contested_0", "contested_1"), F.lit(False)), "contested")
        .when(F.col("digest_1").isNull(), "missing")
        .when(F.col("digest_0").isNull(), "extra")
        .otherwise("altered")
    )
    columns = [
        "archive",
        F.col("at").alias("start"),
        F.col("length_0").alias("length"),
        F.col("length_1").alias("other_length"),
        F.col("digest_0").alias("digest"),
        F.col("digest_1").alias("other_digest"),
    ]
    records = _differing(found, "length", "contested").select(*columns, status.alias("status"))
    lost = "(archive is null or start is null) and digest is not null"
    none, nothing = F.lit(None).cast("long"), F.lit(None).cast("binary")
    return records.unionByName(
        first.where(lost).select(
            "archive", "start", "length", none.alias("other_length"),
            "digest", nothing.alias("other_digest"), F.lit("unplaced").alias("status"),
        )
    ).unionByName(
        second.where(lost).select(
            "archive", "start", none.alias("length"), F.col("length").alias("other_length"),
            nothing.alias("digest"), F.col("digest").alias("other_digest"),
            F.lit("unplaced").alias("status"),
        )
    )


def damaged(record: Column) -> Column:
    """A copy of a record, damaged by the first byte of its SHA-256.

    Of 256 records four end in another character, two lose their second half
    and two are lost (null).
    """
    kind = F.conv(F.left(F.sha2(record.cast("binary"), 256), F.lit(2)), 16, 10).cast("int")
    return (
        F.when(kind < 4, F.concat(F.left(record, F.length(record) - 1), F.lit("X")))
        .when(kind < 6, F.left(record, F.floor(F.length(record) / 2).cast("int")))
        .when(kind < 8, F.lit(None))
        .otherwise(record)
    )


def audited_pages(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pages as WARC records in archives, audited against a damaged copy.

    One row per page: ``page_id``, ``archive``, ``start``, ``length``, the
    record's digest, the copy's (null where lost) and ``status``, ``same`` or
    as in ``audit``. Null addresses and pages are empty; rows are laid out by
    ``page_id`` (null first) and digest, so repeated rows are records of their
    own. Further columns are ignored, and an empty table gives no rows.
    """
    record = F.col("record")
    written = pages.select(
        "page_id", warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record")
    ).withColumn("copy", damaged(record))
    hashed = written.select(
        "page_id",
        F.octet_length("record").cast("long").alias("length"),
        digest(record).alias("digest"),
        F.octet_length("copy").cast("long").alias("copy_length"),
        digest(F.col("copy")).alias("copy_digest"),
    )
    laid = laid_out(hashed, ["page_id", "digest"], archive_bytes)
    copy = laid.select(
        "archive",
        "start",
        F.col("copy_length").alias("length"),
        F.col("copy_digest").alias("digest"),
    )
    found = audit(laid, copy).select(
        F.col("archive").alias("found_archive"),
        F.col("start").alias("found_start"),
        "other_digest",
        "status",
    )
    here = (F.col("archive") == F.col("found_archive")) & (F.col("start") == F.col("found_start"))
    # What the audit does not name is as it was.
    named = F.col("status").isNotNull()
    return laid.join(found, here, "left").select(
        "page_id",
        "archive",
        "start",
        "length",
        "digest",
        F.when(named, F.col("other_digest")).otherwise(F.col("digest")).alias("copy_digest"),
        F.coalesce("status", F.lit("same")).alias("status"),
    )
