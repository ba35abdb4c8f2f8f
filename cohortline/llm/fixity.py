"""Merkle fixity audit of record archives: trees over records and ordered offset ranges, compared from the roots down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import cut

#: Records of an archive file, and children of a tree node.
FILE_RECORDS = 256
FANOUT = 16


def warc_record(url: Column, body: Column) -> Column:
    """A response record as bytes: header lines, an empty line, the body, two line ends. Nulls are empty."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def records(pages: DataFrame) -> DataFrame:
    """file, place, key, start, length, hash of each page as a record of an archive.

    Page p belongs to file floor(p / FILE_RECORDS) and is placed by id, then by
    its hash; start is its byte offset in the file. A null id goes to file -1.
    """
    made = pages.select(F.col("page_id").cast("long").alias("key"), warc_record(F.col("url"), F.col("html")).alias("record"))
    made = made.select(F.coalesce(F.floor(F.col("key") / FILE_RECORDS), F.lit(-1)).cast("long").alias("file"), "key",
                       F.octet_length("record").cast("long").alias("length"), F.sha2(F.col("record").cast("binary"), 256).alias("hash"))
    order = W.partitionBy("file").orderBy(F.col("key").asc_nulls_first(), "hash")
    return made.select(
        "file", (F.row_number().over(order) - 1).cast("long").alias("place"), "key",
        (F.sum("length").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("length")).alias("start"),
        "length", "hash")


def _level(below: DataFrame, file: Column, node: Column) -> DataFrame:
    """One level up: nodes of at most FANOUT children, whose hash covers the children's hashes and ranges in order."""
    children = F.sort_array(F.collect_list(F.struct("file", "node", "start", "length", "hash")))
    text = F.array_join(F.transform(F.col("children"), lambda c: F.concat_ws(":", c["start"], c["length"], c["hash"])), "\n")
    return below.groupBy(file.alias("up_file"), node.alias("up_node")).agg(
        children.alias("children"), F.min("start").alias("start"), F.sum("length").alias("length")).select(
        F.col("up_file").alias("file"), F.col("up_node").alias("node"), "start", "length", F.sha2(text, 256).alias("hash"))


def tree(leaves: DataFrame, file_levels: int, top_levels: int) -> DataFrame:
    """level, file, node, start, length, hash of all nodes; level 0 are the records, the last level is the root.

    Inside a file, nodes join FANOUT by FANOUT; file_levels is enough for the
    longest file. Then files join in the same way, up to one root. A node holds
    at most FANOUT children, so no task gathers more.
    """
    now = leaves.select("file", F.col("place").alias("node"), "start", "length", "hash")
    levels = [now]
    for _ in range(file_levels):
        now = _level(now, F.col("file"), F.floor(F.col("node") / FANOUT))
        levels.append(now)
    for _ in range(top_levels):
        now = _level(now, F.floor(F.col("file") / FANOUT), F.lit(0).cast("long"))
        levels.append(now)
    out = None
    for i, frame in enumerate(levels):
        frame = frame.select(F.lit(i).alias("level"), "file", "node", "start", "length", "hash")
        out = frame if out is None else out.unionByName(frame)
    return out


def _levels(count: int) -> int:
    n = 0
    while count > 1:
        count, n = -(-count // FANOUT), n + 1
    return n


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """Records (file, place) at which two replicas differ, with both sides' key, start, length and hash.

    Both replicas' trees are written once, by level. Roots are compared; then, a
    level at a time, only children of nodes that differ are joined and compared.
    Equal roots end the audit at once. Cases: a record that one side lacks has
    nulls on that side; a record lost or added inside a file moves those behind
    it, which are reported from there on; empty replicas are equal; an empty and
    a full one differ everywhere.
    """
    sides = [cut(first), cut(second)]
    bounds = [s.agg(F.max("place"), F.min("file"), F.max("file")).first() for s in sides]
    filled = [b for b in bounds if b[0] is not None]
    file_levels = _levels(1 + max((b[0] for b in filled), default=0))
    # file -1, for null ids, keeps a second node at every level; one more level joins it
    low, high = min((b[1] for b in filled), default=0), max((b[2] for b in filled), default=0)
    top_levels = _levels(high + 1)
    trees = []
    for s in sides:
        whole = tree(s, file_levels, top_levels)
        trees.append(cut(whole))
    roots = file_levels + top_levels
    suspects = None
    for level in range(roots, -1, -1):
        a, b = (t.where(F.col("level") == level).select("file", "node", *[F.col(c).alias(f"{c}_{n}") for c in ("start", "length", "hash")])
                for t, n in zip(trees, "ab"))
        if suspects is not None:
            if level < file_levels:
                up = [F.col("file"), F.floor(F.col("node") / FANOUT)]
            else:
                up = [F.floor(F.col("file") / FANOUT), F.lit(0).cast("long")]
            a, b = (x.withColumns({"up_file": up[0], "up_node": up[1]}).join(suspects, ["up_file", "up_node"], "left_semi").drop(
                "up_file", "up_node") for x in (a, b))
        differ = a.join(b, ["file", "node"], "full").where(
            ~F.col("hash_a").eqNullSafe(F.col("hash_b")) | ~F.col("start_a").eqNullSafe(F.col("start_b")))
        differ = cut(differ)
        suspects = differ.select(F.col("file").alias("up_file"), F.col("node").alias("up_node"))
        if level and not suspects.take(1):
            return _named(differ, sides)
    return _named(differ, sides)


def _named(differ: DataFrame, sides: list[DataFrame]) -> DataFrame:
    for side, n in zip(sides, "ab"):
        keys = side.select("file", F.col("place").alias("node"), F.col("key").alias(f"key_{n}"))
        differ = differ.join(keys, ["file", "node"], "left")
    return differ.select("file", F.col("node").alias("place"), *[f"{c}_{n}" for n in "ab" for c in ("key", "start", "length", "hash")])
