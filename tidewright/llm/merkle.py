"""A Merkle manifest of a table: every row is a leaf, every group (a language, say) a subtree, the subtrees make the root.

Leaves are digested by Spark, numbered within their group over all tasks (by ranges, so that a group of any size is spread), and cut
into aligned blocks of 8^3. In one task a block is walked recursively in postorder: a subtree returns its digest, and while the
calls unwind each node appends its siblings to the paths of the leaves that it holds. The roots of the blocks are the leaves of the
next distributed walk, until each group has one; the groups' roots are walked in the same way. A leaf's path is its own block's
followed by those of the blocks above it, joined by block, so nothing of the tree passes through the driver.

A node is the SHA-256 of its children's digests as lowercase hex, 8 children at most; the last node of a level may have fewer,
even one. A path has for each level a byte with the node's place, a byte with the number of its siblings, and their digests.

Defined cases: a null field is `-`, any other its number of UTF-8 bytes, a colon and its text; a null group comes before all
others, groups are ordered by their bytes; null ids come first in their group, and rows with one id are ordered by their leaves, so
repeated rows are leaves of their own; an empty table gives no rows; columns that aren't fields of the leaf are not read, whatever
their names; a text of any length is digested whole.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm.common import crc_of, stage

FAN = 8
#: Levels that one task walks at once: a block has FAN ** DEPTH leaves at most.
DEPTH = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_of(*fields: Column) -> Column:
    """The digest of a row's fields, as 32 bytes."""
    parts = []
    for f in fields:
        text = f.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def node_of(digests) -> bytes:
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def walk(leaves: list[bytes], levels: int) -> tuple[bytes, list[bytes]]:
    """The digest of a block after so many levels, and the path of each of its leaves."""
    paths = [[] for _ in leaves]

    def unwind(lo: int, hi: int, span: int) -> bytes:
        if span == 1:
            return leaves[lo]
        ranges = [(a, min(a + span // FAN, hi)) for a in range(lo, hi, span // FAN)]
        digests = [unwind(a, b, span // FAN) for a, b in ranges]
        for k, (a, b) in enumerate(ranges):
            step = bytes([k, len(ranges) - 1]) + b"".join(digests[:k] + digests[k + 1 :])
            for path in paths[a:b]:
                path.append(step)
        return node_of(digests)

    return unwind(0, len(leaves), FAN**levels), [b"".join(p) for p in paths]


def steps(path: bytes):
    """(place, siblings) of each level of a path."""
    at = 0
    while at < len(path):
        end = at + 2 + 32 * path[at + 1]
        yield path[at], [path[k : k + 32] for k in range(at + 2, end, 32)]
        at = end


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for place, siblings in steps(path):
        leaf = node_of([*siblings[:place], leaf, *siblings[place:]])
    return leaf


def numbered_in_groups(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (staged, with a column g) with i, the row's number within its g in this order from 0, and n, the rows of its g. Rows are
    ranked within ranges of (g, order), and ranges of one g are added up, so that no task sees a whole group."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = rows.columns
    ranged = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = stage(ranged.repartitionByRange(parts, "g", *order, "tie").withColumn("part", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("g", "part").agg(F.count(F.lit(1)).alias("size"))
    # a row for each range and group that meet: about as many as both together
    starts = counts.selectExpr("g", "part", "sum(size) OVER (PARTITION BY g ORDER BY part) - size AS start", "sum(size) OVER (PARTITION BY g) AS n")
    own = ", ".join(f"`{c}`" for c in (*order, "tie"))
    ranked = ranged.withColumn("own", F.expr(f"row_number() OVER (PARTITION BY g, part ORDER BY {own})"))
    return ranked.join(starts, ["g", "part"]).select(*kept, (F.col("start") + F.col("own") - 1).alias("i"), "n")


def _walk_blocks(rows: DataFrame) -> DataFrame:
    """rows (g, i, n, h, ...) with their path within their block, and the block's root."""
    size = FAN**DEPTH
    schema = T.StructType([*rows.schema.fields, T.StructField("path", T.BinaryType()), T.StructField("top", T.BinaryType())])

    def walked(block: pa.Table) -> pa.Table:
        block = block.drop_columns(["block"]).sort_by("i")
        n, levels = block.column("n")[0].as_py(), 0
        while levels < DEPTH and FAN**levels < n:
            levels += 1
        top, paths = walk(block.column("h").to_pylist(), levels)
        return block.append_column("path", pa.array(paths, pa.binary())).append_column("top", pa.array([top] * len(paths), pa.binary()))

    return rows.withColumn("block", F.floor(F.col("i") / size)).groupBy("g", "block").applyInArrow(walked, schema)


def paths_to_top(rows: DataFrame) -> DataFrame:
    """rows (g, i, n, h, ...) with the path to their group's root, and this root as top."""
    size = FAN**DEPTH
    kept, most, levels = rows.columns, rows.agg(F.max("n")).first()[0] or 0, []
    block = F.floor(F.col("i") / size)
    while True:
        levels.append(stage(_walk_blocks(rows), "walked"))
        most = -(-most // size)
        if most <= 1:
            break
        rows = levels[-1].filter(F.col("i") % size == 0).select("g", block.alias("i"), F.ceil(F.col("n") / size).alias("n"), F.col("top").alias("h"))
    above = levels.pop()
    while levels:  # a row of the upper walk stands for a block of the lower one
        above = above.select("g", F.col("i").alias("block"), F.col("path").alias("higher"), "top")
        above = levels.pop().drop("top").withColumn("block", block).join(above, ["g", "block"]).withColumn("path", F.concat("path", "higher"))
    return above.select(*kept, "path", "top")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS, tampered: Column | None = None) -> DataFrame:
    """One row per row of docs: id, leaf, tampered (the leaf of the fields with the texts' A-Z in lower case where the condition holds,
    else null), subroot, root, and the leaf's path to the root."""
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    other = leaf_of(*[F.translate(F.col(f), _UPPER, _LOWER) if f == "text" else F.col(f) for f in fields])
    changed = F.lit(None).cast("binary") if tampered is None else F.when(tampered, other)
    leaves = stage(docs.select(F.col(id_col).alias("id"), group.alias("g"), leaf_of(*map(F.col, fields)).alias("h"), changed.alias("tampered")), "leaves")
    low = stage(paths_to_top(numbered_in_groups(leaves, ["id", "h"])), "leaf-paths")
    groups = stage(low.filter("i = 0").select(F.col("g").alias("name"), F.col("top").alias("h")).withColumn("g", F.lit("")), "groups")
    high = paths_to_top(numbered_in_groups(groups, ["name"])).select(F.col("name").alias("g"), F.col("path").alias("higher"), F.col("top").alias("root"))
    return low.join(high, "g").select("id", F.col("h").alias("leaf"), "tampered", F.col("top").alias("subroot"), "root", F.concat("path", "higher").alias("path"))


def check(leaves: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per leaf of a manifest: its digests in hex, proof_sha256 (of the siblings up to the root), folded_root, which the leaf
    (the tampered one, if any) leads to, and verified, whether that is the root."""
    schema = T.StructType([T.StructField(id_col, leaves.schema["id"].dataType), *T._parse_datatype_string("leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean").fields])

    def checked(batches):
        for b in batches:
            leaf, tampered, subroot, root, path = (b.column(n).to_pylist() for n in ("leaf", "tampered", "subroot", "root", "path"))
            proofs = [sha256("".join(d.hex() for _, ds in steps(p) for d in ds).encode()).hexdigest() for p in path]
            folded = [fold(x if y is None else y, p) for x, y, p in zip(leaf, tampered, path, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array([x.hex() for x in v]) for v in (leaf, subroot, root)), pa.array(proofs, pa.string()), pa.array([x.hex() for x in folded], pa.string()), pa.array([x == y for x, y in zip(folded, root, strict=True)], pa.bool_())],
                names=schema.names,
            )

    return leaves.select("id", "leaf", "tampered", "subroot", "root", "path").mapInArrow(checked, schema)


def is_tampered(id_col: str = "doc_id") -> Column:
    """A third of the ids, by their CRC; rows without an id are left alone."""
    return F.col(id_col).isNotNull() & (crc_of(id_col) % 3 == 0)
