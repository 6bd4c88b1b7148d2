"""Fixity audit of archived records with Merkle trees.

A record's leaf is the digest of its bytes. Leaves in order of offset are hashed into
ranges of a fixed number of bytes of their file, ranges into wider ranges, up to one root
per file and one per replica. Two replicas are compared from the roots down; only children
of branches that differ are looked at, and the leaves of differing ranges give the records.

A null payload counts as an empty record. Equal records with one key are one leaf, with the
number of copies in its digest, so a key with any number of copies stays small. Records at the
same offset are hashed together in order of their digests. Records without a file number (a
null or negative one), and those of a file with far more records than it should have, are dealt
by digest to further files of bounded size. A record that one replica lacks is missing there.
Empty replicas have no root; two of them agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stallmetrics.llm.common import done, written

#: Bytes of the lowest range and children of a node.
RANGE_BYTES = 1 << 16
FANOUT = 16
#: Records of a file, and how many times as many make it a crowded one that is divided.
FILE_RECORDS = 512
CROWDED = 4
#: Parts over which the records of one file are spread where files are joined with their sizes.
SALTS = 64


def warc_record(url: Column, payload: Column) -> Column:
    """The bytes of a response record, headers first."""
    body = F.coalesce(payload, F.lit("")).cast("binary")
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def _in_files(leaves: DataFrame, per_file: int) -> DataFrame:
    """``leaves`` with the file that each goes to; ``file`` is -1 for those without one."""
    most = leaves.agg(F.max("file").alias("file")).first()["file"]
    sizes = leaves.groupBy(F.col("file").alias("crowded")).agg(F.ceil(F.count("*") / per_file).alias("pieces"))
    crowded = sizes.filter((F.col("crowded") < 0) | (F.col("pieces") > CROWDED))
    if most is None or crowded.isEmpty():
        return leaves
    # files of pieces come after all others: the k-th piece of file f is file (k + 1) * base + f + 1
    base = F.lit(most + 2)
    crowded = crowded.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = leaves.withColumn("salt", F.pmod(F.xxhash64("digest"), F.lit(SALTS))).join(
        crowded, (F.col("file") == F.col("crowded")) & (F.col("salt") == F.col("part")), "left")
    piece = (F.pmod(F.xxhash64(F.lit("piece"), "digest"), F.col("pieces")) + 1) * base + F.col("file") + 1
    return joined.withColumn("file", F.coalesce(piece, F.col("file")).cast("long")).drop("salt", "part", "crowded", "pieces")


def records(rows: DataFrame, key: str, file: Column, record: Column, altered: Column | None = None,
            per_file: int = FILE_RECORDS) -> DataFrame:
    """(file, offset, length, digest, key, copies): records one after another in their files, in order of key.

    The result is written. Only lengths and digests are shuffled. ``altered`` is the record as a replica has it
    at the same place; its digest is kept beside the other as ``altered``.
    """
    made = rows.select(F.col(key).alias("key"), file.alias("file"), record.alias("record"),
                       (record if altered is None else altered).alias("altered"))
    made = made.select("key", F.when(F.col("file") >= 0, F.col("file").cast("long")).otherwise(F.lit(-1)).alias("file"),
                       F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"),
                       F.sha2("altered", 256).alias("altered"))
    leaves = written(made.groupBy("key", "file", "length", "digest", "altered").agg(F.count("*").alias("copies")), "leaves")
    order = Window.partitionBy("file").orderBy("key", "digest", "altered").rowsBetween(Window.unboundedPreceding, -1)
    counted = lambda c: F.when(F.col("copies") > 1, F.sha2(F.concat_ws(":", c, "copies"), 256)).otherwise(F.col(c)).alias(c)
    placed = _in_files(leaves, per_file).withColumn("length", F.col("length") * F.col("copies"))
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long"))
    extra = [] if altered is None else [counted("altered")]
    out = written(placed.select("file", "offset", "length", counted("digest"), "key", "copies", *extra), "manifest")
    done(leaves)
    return out


def _parent(k: int, range_levels: int, fanout: int) -> list[Column]:
    """(file, node) above a node of level ``k``: wider ranges up to the file, then groups of files."""
    if k < range_levels - 1:
        return [F.col("file"), F.floor(F.col("node") / fanout)]
    return [F.lit(-1).cast("long"), F.floor(F.col("file" if k == range_levels - 1 else "node") / fanout)]


def _hashed(level: DataFrame, order: str) -> DataFrame:
    """One node for the children with the same (up_file, up_node): the digest of their digests in order."""
    children = F.array_sort(F.collect_list(F.struct(order, "digest")))
    return (level.groupBy("up_file", "up_node")
            .agg(F.sha2(F.array_join(F.transform(children, lambda x: x["digest"]), ""), 256).alias("digest"))
            .select(F.col("up_file").alias("file"), F.col("up_node").alias("node"), "digest"))


def _below(level: DataFrame, k: int, shape: tuple[int, int], fanout: int) -> DataFrame:
    file, node = _parent(k, shape[0], fanout)
    return level.withColumns({"up_file": file.cast("long"), "up_node": node.cast("long")})


def tree(leaves: DataFrame, shape: tuple[int, int], range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Nodes (file, node, digest) of each level, from the byte ranges up to the one root.

    A node gathers the records of one byte range, or ``fanout`` nodes: both are bounded. Each
    level is written, so that going down reads it instead of hashing again.
    """
    ranged = leaves.withColumns({"up_file": F.col("file"), "up_node": F.floor(F.col("offset") / range_bytes).cast("long")})
    out = [written(_hashed(ranged, "offset"), "level")]
    for k in range(sum(shape) - 1):
        order = "file" if k == shape[0] - 1 else "node"
        out.append(written(_hashed(_below(out[-1], k, shape, fanout), order), "level"))
    return out


def shape_of(leaves: list[DataFrame], range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> tuple[int, int]:
    """Levels of ranges in a file, and of groups of files above them, that lead to one root for all given replicas."""

    def levels(nodes: int) -> int:
        n = 0
        while nodes > 1:
            nodes, n = -(-nodes // fanout), n + 1
        return n

    most = [x.agg(F.max("offset").alias("offset"), F.max("file").alias("file")).first() for x in leaves]
    offset, file = (max((m[c] or 0) for m in most) for c in ("offset", "file"))
    return levels(offset // range_bytes + 1) + 1, levels(file + 1)


def roots(left: DataFrame, right: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> tuple[str | None, str | None]:
    """The root digest of each replica; null where it has no record."""
    shape = shape_of([left, right], range_bytes, fanout)
    found = [tree(x, shape, range_bytes, fanout)[-1].first() for x in (left, right)]
    return tuple(f["digest"] if f else None for f in found)


def _differing(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    a = left.select(*on, F.col("digest").alias("left_digest"))
    b = right.select(*on, F.col("digest").alias("right_digest"))
    return a.join(b, on, "full_outer").filter(~F.col("left_digest").eqNullSafe(F.col("right_digest"))).select(*on)


def audit(left: DataFrame, right: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """(file, offset, key, finding) of each record that differs: changed, missing or added in ``right``."""
    shape = shape_of([left, right], range_bytes, fanout)
    lefts, rights = (tree(x, shape, range_bytes, fanout) for x in (left, right))
    wrong = _differing(lefts[-1], rights[-1], ["file", "node"])
    for k in range(sum(shape) - 2, -1, -1):
        parents = wrong.select(F.col("file").alias("up_file"), F.col("node").alias("up_node"))
        a, b = (_below(x[k], k, shape, fanout).join(parents, ["up_file", "up_node"], "left_semi") for x in (lefts, rights))
        above, wrong = wrong, written(_differing(a, b, ["file", "node"]), "wrong")
        done(*([above] if k < sum(shape) - 2 else []), lefts[k + 1], rights[k + 1])

    def inside(leaves: DataFrame, name: str) -> DataFrame:
        found = leaves.withColumn("node", F.floor(F.col("offset") / range_bytes).cast("long")).join(wrong, ["file", "node"], "left_semi")
        return found.groupBy("file", "offset").agg(
            F.min("key").alias(f"{name}_key"), F.array_join(F.array_sort(F.collect_list("digest")), "").alias(f"{name}_digest"))

    both = inside(left, "left").join(inside(right, "right"), ["file", "offset"], "full_outer")
    return both.filter(~F.col("left_digest").eqNullSafe(F.col("right_digest"))).select(
        "file", "offset", F.coalesce("left_key", "right_key").alias("key"),
        F.when(F.col("right_digest").isNull(), "missing").when(F.col("left_digest").isNull(), "added")
        .otherwise("changed").alias("finding"))
