"""Merkle manifest of a dataset: a leaf per row, a tree of every three consecutive nodes per source, and one
over the sources.

Leaves are numbered within their source by a range partition, whose counts are added up, so that no task holds
a source. Each run of 3^DEPTH leaves that starts at a multiple of that number is a block: one row that holds
every level of its part of the tree as one string of 64 hex digits a node. SQL takes parents from it as digests
of 192 digits at a time, and the siblings of a node as the digits to its left and right. The tops of the blocks
are the nodes of the next tier, which is built the same way until one node is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleanframe.llm.tables import stored
from gleanframe.operators.columns import with_once

WAYS = 3  # fixed value: children of a node
DEPTH = 5  # levels of a block, which has WAYS ** DEPTH leaves at most
DIGEST = 64


def field(column: Column) -> Column:
    """A value as it enters a digest: its bytes, their number before them; `-` for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Add the place ``i`` of a row within its group, from 0 (nulls first), and ``n``, the rows of the group.

    Rows that are equal in all order columns are spread over tasks as well; which of them comes first makes
    no difference to a reader of those columns.
    """
    spread = rows.withColumn("_salt", F.rand(1)).repartitionByRange(*group, *order, "_salt")
    placed = stored(
        spread.sortWithinPartitions(*group, *order).drop("_salt").withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "leaves")
    # a row per task and group in it: few rows of any group
    parts = placed.groupBy("_part", *group).agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    all_of = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_rows").over(
        all_of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = parts.select(
        F.col("_part").alias("_of"), *[F.col(g).alias(f"_{k}") for k, g in enumerate(group)],
        (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(all_of).alias("n"))
    same = F.col("_part") == F.col("_of")
    for k, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_{k}"))
    return placed.join(starts, same).select(
        *rows.columns, (F.col("_at") + F.col("_shift")).alias("i"), "n")


def _parents(level: str) -> Column:
    """The level above one that is a string of digests: of each run of WAYS digests the digest."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / F.lit(DIGEST * WAYS)).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda r: F.sha2(
        F.substr(F.col(level), r * DIGEST * WAYS + 1, F.lit(DIGEST * WAYS)), 256)), "")


def _blocks(nodes: DataFrame, group: list[str], depth: int, carried: list[str]) -> DataFrame:
    """Rows (group, i, n, digest, carried) as one row per block: its number ``b``, ``n``, its ``items`` in order,
    its levels ``level_0``... as strings, null above its top, and its ``top``.

    A block of several climbs ``depth`` levels, however few nodes it has; one that is alone climbs until a
    single node is left.
    """
    size = WAYS ** depth
    rows = nodes.groupBy(*group, F.floor(F.col("i") / size).alias("b")).agg(
        F.first("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("i", "digest", *carried))).alias("items"))
    rows = with_once(rows, "level_0", F.array_join(F.transform("items", lambda x: x["digest"]), ""))
    for k in range(depth):
        climbs = (F.col("n") > size) | (F.length(f"level_{k}") > DIGEST)
        rows = with_once(rows, f"level_{k + 1}", F.when(climbs, _parents(f"level_{k}")))
    return rows.withColumn("top", F.coalesce(*[F.col(f"level_{k}") for k in range(depth, -1, -1)]))


def _siblings(position: Column, depth: int) -> list[Column]:
    """For each level of a block the digits beside the node above ``position``, as (left, right); null where the
    level is the top."""
    out = []
    for k in range(depth):
        node = F.floor(position / F.lit(WAYS ** k)).cast("int")
        begin = F.floor(node / F.lit(WAYS)).cast("int") * DIGEST * WAYS
        inside = (node % WAYS) * DIGEST
        level = F.col(f"level_{k}")
        out.append(F.when(F.col(f"level_{k + 1}").isNotNull(), F.struct(
            F.substr(level, begin + 1, inside).alias("left"),
            F.substr(level, begin + inside + DIGEST + 1, F.lit(DIGEST * (WAYS - 1)) - inside).alias("right"))))
    return out


def _joined_path(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest leads to, beside the siblings of its path."""
    return F.aggregate(path, digest, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def blocks_of(nodes: DataFrame, group: list[str], depth: int = DEPTH, carried: tuple[str, ...] = ()) -> DataFrame:
    """Nodes (group, i, n, digest, carried) as blocks, each with ``above``, the siblings from its own top to that of its
    group, an array of (left, right), and that ``top``.

    Each tier has at most one node in WAYS ** depth of the one below; the blocks of a tier are stored before
    they are joined with the paths of their tops.
    """
    blocks = stored(_blocks(nodes, group, depth, list(carried)), "blocks")
    size = WAYS ** depth
    if blocks.filter(F.col("n") > size).isEmpty():
        return blocks.withColumn("above", F.array().cast("array<struct<left:string,right:string>>"))
    tops = blocks.select(*group, F.col("b").alias("i"), F.ceil(F.col("n") / size).alias("n"),
                         F.col("top").alias("digest"))
    above = with_paths(blocks_of(tops, group, depth), group, depth).select(
        *[F.col(g).alias(f"_{k}") for k, g in enumerate(group)], F.col("i").alias("_b"),
        F.col("path").alias("above"), F.col("top").alias("_top"))
    same = F.col("b") == F.col("_b")
    for k, g in enumerate(group):
        same &= F.col(g).eqNullSafe(F.col(f"_{k}"))
    return blocks.join(above, same).withColumn("top", F.col("_top"))


def with_paths(blocks: DataFrame, group: list[str], depth: int = DEPTH, carried: tuple[str, ...] = (),
               also: tuple[str, ...] = ()) -> DataFrame:
    """A row per node of the blocks, with the ``path`` of its siblings to the top of its group; ``also`` names
    columns of the blocks to keep."""
    items = blocks.select("*", F.posexplode("items").alias("_pos", "_item"))
    path = F.filter(F.array(*_siblings(F.col("_pos"), depth)), lambda s: s.isNotNull())
    return items.select(
        *group, F.col("_item.i").alias("i"), "n", F.col("_item.digest").alias("digest"),
        *[F.col(f"_item.{c}").alias(c) for c in carried], F.concat(path, "above").alias("path"), "top", *also)


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, the ``leaf`` of a row and its ``tampered`` one.

    Tampering deletes the line breaks of a text whose id has an even CRC-32; a null id has none, and its row
    stays as it is.
    """
    known = [F.col("doc_id").cast("bigint"), F.col("source"), F.col("lang"), F.col("n_chars")]
    text = F.col("text").cast("string")
    plain = F.regexp_replace(text, "\n", "")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("bigint").cast("string")) % 2 == 0, F.lit(False))
    leaf = leaf_digest([*known, text])
    tampered = F.when(changed & F.contains(text, F.lit("\n")), leaf_digest([*known, plain])).otherwise(leaf)
    rows = docs.select(known[0].alias("doc_id"), F.col("source").cast("string").alias("source"),
                       leaf.alias("leaf"), tampered.alias("tampered"))
    return stored(rows, "digests")


def manifest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row per document: its leaf, the roots of its source and of the table, the digest of its proof, the
    root that its tampered row and that proof lead to, and whether that is the root.

    Ids order the leaves of a source, a null id first; rows of one id by leaf. A null source is one of its own
    and comes first, an empty text is not a null one, and other columns do not count. Rows that are equal get
    equal leaves at neighbouring places. An empty table has no rows and no root.
    """
    nodes = numbered(leaves(docs), ["source"], ["doc_id", "leaf", "tampered"]).withColumnRenamed("leaf", "digest")
    blocks = blocks_of(nodes, ["source"], depth, ("doc_id", "tampered"))
    subroots = blocks.filter("b = 0").select("source", F.col("top").alias("digest"), F.lit(0).alias("_all"))
    subroots = numbered(subroots, ["_all"], ["source", "digest"])
    roots = stored(with_paths(
        blocks_of(subroots, ["_all"], depth, ("source",)), ["_all"], depth, ("source",)).select(
        F.col("source").alias("_source"), F.col("path").alias("_path"), F.col("top").alias("root")), "roots")
    blocks = blocks.join(roots, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "above", F.concat("above", "_path"))
    rows = with_paths(blocks, ["source"], depth, ("doc_id", "tampered"), also=("root",))
    shown = rows.select(
        "doc_id", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), "root",
        F.sha2(_joined_path(F.col("path")), 256).alias("proof_sha256"),
        fold(F.col("tampered"), F.col("path")).alias("folded_root"))
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))
