"""Merkle fixity audit of replicated WARC files.

Records are hashed, offsets are cut into ranges of fixed length, and ranges into ever longer ones, up to one root per
file.  Replicas compare roots first and go down only where branches differ, so the rows that an audit compares grow
with the damage and not with the archive.  A record that is missing on one side moves no range, since ranges are
given by offsets and not by counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

RANGE = 64 * 1024
FANOUT = 16


def warc_record(url: Column, payload: Column) -> Column:
    """The bytes of a WARC/1.1 resource record; a null url or payload counts as empty."""
    body = F.coalesce(payload, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.sha2(body, 256),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def damaged(record: Column) -> Column:
    """The record with another last byte, which is a line feed in every whole record."""
    return F.concat(record.substr(F.lit(1), F.octet_length(record) - 1), F.lit(b"\x00"))


def record_index(records: DataFrame, record: Column, *carried: str) -> DataFrame:
    """(file, offset, length, digest, carried...): one file per partition of ``records``, records in their order."""
    rows = records.select(
        F.spark_partition_id().alias("file"), F.monotonically_increasing_id().alias("_at"), *carried, record.alias("_bytes")
    ).select("file", "_at", *carried, F.octet_length("_bytes").cast("bigint").alias("length"), F.sha2("_bytes", 256).alias("digest"))
    before = F.expr("sum(length) OVER (PARTITION BY file ORDER BY _at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    return rows.withColumn("offset", F.coalesce(before, F.lit(0)).cast("bigint")).drop("_at")


def _nodes(children: DataFrame, part: Column) -> DataFrame:
    """One node per (file, part): the hash of its children's hashes in the order of their offsets."""
    ordered = F.array_sort(F.collect_list(F.struct("node", "digest")))
    return children.groupBy("file", part.alias("above")).agg(ordered.alias("c")).select(
        "file", F.col("above").alias("node"), F.sha2(F.concat_ws("", F.transform("c", lambda x: F.concat(x["node"].cast("string"), F.lit(":"), x["digest"]))), 256).alias("digest")
    )


def merkle_tree(records: DataFrame, levels: int, length: int = RANGE, fanout: int = FANOUT) -> list[DataFrame]:
    """Stored levels of (file, node, digest): records by offset, then ranges, then longer ranges up to the root.

    Rows that repeat an offset of a file become one leaf of their count, least and greatest digest, so a node
    never gathers more than the bytes of its range allow.
    """
    leaf = F.sha2(F.concat_ws("|", F.count(F.lit(1)).cast("string"), F.min("digest"), F.max("digest")), 256)
    tree = [stored(records.groupBy("file", F.col("offset").alias("node")).agg(leaf.alias("digest")))]
    for level in range(levels):
        width = length if level == 0 else fanout
        tree.append(stored(_nodes(tree[-1], F.floor(F.col("node") / width))))
    return tree


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes that differ or are on one side only, with what is wrong with them on the right."""
    l, r = left.withColumnRenamed("digest", "_l"), right.withColumnRenamed("digest", "_r")
    both = l.join(r, ["file", "node"], "full_outer").where(~F.col("_l").eqNullSafe(F.col("_r")))
    fault = F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "extra").otherwise("changed")
    return both.select("file", "node", fault.alias("fault"))


def fixity_audit(left: DataFrame, right: DataFrame, length: int = RANGE, fanout: int = FANOUT) -> DataFrame:
    """Rows (file, offset, fault) of records that are not the same in two replicas (file, offset, digest).

    ``fault`` tells what is wrong on the right: changed, missing or extra.  Null digests count as empty; rows
    without file or offset can't be placed and are left out.  Repeated rows are one record that differs from a
    single one.  Empty replicas differ in every record of the other; two empty ones in none.
    """
    placed = [r.where("file IS NOT NULL AND offset IS NOT NULL").select("file", "offset", F.coalesce("digest", F.lit("")).alias("digest")) for r in (left, right)]
    last = max((r.agg(F.max("offset").alias("m")).first().m or 0) for r in placed)
    levels, nodes = 1, last // length
    while nodes:
        levels, nodes = levels + 1, nodes // fanout
    trees = [merkle_tree(r, levels, length, fanout) for r in placed]
    found = _differing(trees[0][-1], trees[1][-1])
    for level in range(levels - 1, -1, -1):
        width = length if level == 0 else fanout
        above = stored(found.select("file", F.col("node").alias("above")))
        sides = [t[level].withColumn("above", F.floor(F.col("node") / width)).join(above, ["file", "above"], "left_semi").drop("above") for t in trees]
        found = _differing(*sides)
    return found.select("file", F.col("node").alias("offset"), "fault")
