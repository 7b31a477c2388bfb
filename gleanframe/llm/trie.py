"""Prefix trie of conversations as burst tries.

A turn becomes an id of 16 bytes, a conversation the ids of its turns one after the other; equal conversations
become one row that counts them. At first all rows are suffixes in one container below the root. A container of
more turns than the limit bursts: its head becomes a node, at the depth where its rows part, and its rows go by
their next turn id to new containers below. Containers that fit are dealt to the shards by their heads, sorted,
and swept: the common prefix of neighbours says which nodes end. What the sweeps found is added up over the burst
nodes from the deepest up.

Rows never gather under a head before it is small: bursting reads counts per head, and of heads above the
limit there are at most HEADS, because the limit grows with the turns of all rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanframe.llm.tables import stored
from gleanframe.session import reach_workers

ID = 16  # bytes of a turn id
LIMIT = 1 << 10  # turns that a container may hold before it bursts
HEADS = 1 << 16  # containers above the limit, at most
PIECE = 1 << 16  # bytes of a list of ids that are handed on at once
SHARED, FAMILY = 4, 20  # fixed values: a conversation takes fewer than SHARED turns of the first of its FAMILY

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
NOTHING = hashlib.sha256(b"").hexdigest()


def _key(binary: Column) -> Column:
    return F.unhex(F.substr(F.sha2(binary, 256), F.lit(1), F.lit(2 * ID)))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``path`` (the ids of its rebuilt turns), ``words`` (the words of each
    turn) and ``seq``, a key of the path.

    Turns go by number, a null one first; those of one number by their ids, so repeated rows are turns like any
    other. The rows of one conversation meet in one row, as ids and counts; rows without conv_id belong to none.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
        F.substr(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256),
                 F.lit(1), F.lit(2 * ID)).alias("id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    own = stored(conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("turn")).alias("turns")), "turns")
    firsts = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, SHARED - 1).alias("_first"))
    taken = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    none = F.slice("turns", 1, 0)
    turns = F.concat(F.slice(F.coalesce("_first", none), F.lit(1), taken),
                     F.slice("turns", taken + 1, F.greatest(F.size("turns"), F.lit(1))))
    joined = own.join(firsts, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("_base"), "left")
    paths = joined.select("conv_id", turns.alias("turns")).select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("path"),
        F.transform("turns", lambda t: t["words"]).alias("words"))
    return stored(paths.withColumn("seq", _key(F.col("path"))), "paths")


# ---- digests of the members that end at a node

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (seq, conv_id) as pieces of the lists of their ids, in order."""
    part, at, open_seq, ids, size, out = TaskContext.get().partitionId(), 0, None, [], 0, []

    def piece() -> tuple:
        return open_seq, part, at, ",".join(ids)

    for batch in batches:
        for seq, conv in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (seq != open_seq or size > PIECE):
                out.append(piece())
                at, ids, size = at + 1, [], 0
            open_seq = seq
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield _columns(out, ("seq", "part", "at", "piece"))
        out = []
    if ids:
        yield _columns([piece()], ("seq", "part", "at", "piece"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (seq, part, at) as one digest per seq, piece by piece."""
    open_seq, running, out = None, None, []
    for batch in batches:
        for seq, piece in zip(batch.column("seq").to_pylist(), batch.column("piece").to_pylist()):
            if seq == open_seq:
                running.update(b"," + piece.encode())
                continue
            if running:
                out.append((open_seq, running.hexdigest()))
            open_seq, running = seq, hashlib.sha256(piece.encode())
        yield _columns(out, ("seq", "ends"))
        out = []
    if running:
        yield _columns([(open_seq, running.hexdigest())], ("seq", "ends"))


_TYPES = {"seq": pa.binary(), "part": pa.int32(), "at": pa.int64(), "piece": pa.string(), "ends": pa.string()}


def _columns(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    return pa.record_batch({n: pa.array([r[k] for r in rows], _TYPES[n]) for k, n in enumerate(names)})


def end_digests(members: DataFrame) -> DataFrame:
    """Per ``seq`` the SHA-256 of its conversations' ids, ascending, joined by commas. A long list is spread over
    tasks; what meets in one task is its pieces, which go through a running digest."""
    pieces = members.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions(
        "seq", "conv_id").mapInArrow(_pieces, "seq binary, part int, at long, piece string")
    return pieces.repartition("seq").sortWithinPartitions("seq", "part", "at").mapInArrow(
        _digests, "seq binary, ends string")


def sequences(members: DataFrame) -> DataFrame:
    """Distinct rebuilt conversations with their smallest id, their number and the digest of their ids."""
    counted = members.groupBy("seq").agg(
        F.min("conv_id").alias("conv"), F.count("*").alias("n"),
        F.first("path").alias("path"), F.first("words").alias("words"))
    return stored(counted.join(end_digests(members), "seq").drop("seq"), "sequences")


# ---- bursting

def _turns(path: str = "path") -> Column:
    return F.floor(F.octet_length(path) / ID).cast("int")


def _prefix(depth: Column) -> Column:
    return _key(F.substr("path", F.lit(1), depth * ID))


def burst(rows: DataFrame, limit: int = LIMIT) -> tuple[list[DataFrame], list[DataFrame]]:
    """Distinct conversations as rows in containers that fit, and the burst nodes of each round.

    Rows get ``head`` (key of their container), ``depth`` of that head, and of the burst node above it
    the key (``above``) and the conversation (``up``). A burst node stands for a chain: from ``top`` to ``depth``
    nothing branches or ends.
    """
    total = rows.agg(F.sum(_turns() + 1)).first()[0] or 0
    limit = max(limit, total // HEADS)
    rows = rows.withColumns({
        "depth": F.lit(0), "head": _prefix(F.lit(0)), "above": F.lit(None).cast("binary"),
        "up": F.lit(None).cast("bigint")})
    settled, nodes = [], []
    while True:
        large = rows.groupBy("head").agg(F.sum(_turns() + 1).alias("size"), F.count("*").alias("rows")).filter(
            (F.col("size") > limit) & (F.col("rows") > 1)).select(F.col("head").alias("_large"))
        large = stored(large, "large")  # at most HEADS rows
        if large.isEmpty():
            return [*settled, rows], nodes
        over = rows.join(F.broadcast(large), F.col("head") == F.col("_large"))
        settled.append(rows.join(F.broadcast(large), F.col("head") == F.col("_large"), "left_anti"))
        ends = over.groupBy("head").agg(
            F.min("path").alias("low"), F.max("path").alias("high"), F.min("conv").alias("conv"),
            F.sum("n").alias("n"), F.first("words").alias("words"), F.first("depth").alias("top"),
            F.first("above").alias("above"), F.first("up").alias("up"))
        part = F.get(F.filter(F.sequence("top", _turns("low")), lambda k: (
            F.substr("low", k * ID + 1, F.lit(ID)) != F.substr("high", k * ID + 1, F.lit(ID)))), F.lit(0))
        heads = ends.withColumn("depth", part).select(
            "head", "top", "depth", "above", "up", "conv", "n",
            _key(F.substr("low", F.lit(1), F.col("depth") * ID)).alias("key"),
            # words of the turns at the nodes of the chain; the root has no turn
            F.slice(F.concat(F.array(F.lit(0)), "words"), F.col("top") + 1, F.col("depth") - F.col("top") + 1).alias(
                "words"))
        heads = stored(heads, "heads")
        known = F.broadcast(heads.select(
            F.col("head").alias("_head"), F.col("depth").alias("_depth"), F.col("key").alias("_key"),
            F.col("conv").alias("_conv")))
        moved = stored(rows.join(known, F.col("head") == F.col("_head")).select(
            "path", "words", "conv", "n", "ends", (F.col("_depth") + 1).alias("depth"),
            _prefix(F.col("_depth") + 1).alias("head"), F.col("_key").alias("above"), F.col("_conv").alias("up")),
            "burst")
        # at most one row of a container ends where it branches
        here = moved.filter(_turns() < F.col("depth")).select(
            F.col("above").alias("key"), F.col("ends").alias("ends"))
        nodes.append(heads.join(here, "key", "left"))
        rows = moved.filter(_turns() >= F.col("depth"))


# ---- sweeping

class _Open:
    """A node whose members are still coming."""

    __slots__ = ("depth", "conv", "n", "children", "leaves", "saved", "ends", "below")

    def __init__(self, depth: int):
        self.depth, self.conv, self.n, self.ends = depth, None, 0, NOTHING
        self.children = self.leaves = self.saved = 0
        self.below: list[tuple] = []  # rows of its children, which lack its conversation

    def take(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.n += n


def common_turns(a: bytes, b: bytes, start: int) -> int:
    """Number of turns that two paths share, which is ``start`` at least."""
    most = min(len(a), len(b)) // ID
    while start < most and a[start * ID:start * ID + ID] == b[start * ID:start * ID + ID]:
        start += 1
    return start


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (head, path) as the nodes of their containers; the top of a container names the burst node
    above it."""
    out: list[tuple] = []
    stack: list[_Open] = []
    last: dict = {}

    def close() -> None:
        node = stack.pop()
        leaves = node.leaves or 1
        saved = node.saved + (node.n - 1) * (last["words"][node.depth - 1] if node.depth else 0)
        out.extend((conv, depth, node.conv, *rest, None) for conv, depth, *rest in node.below)
        row = (node.conv, node.depth, node.n, node.children, leaves, saved, node.ends)
        if stack:
            above = stack[-1]
            above.take(node.conv, node.n)
            above.children += 1
            above.leaves += leaves
            above.saved += saved
            above.below.append(row)
        else:
            out.append((row[0], row[1], last["up"], *row[2:], last["above"]))

    for batch in batches:
        for row in batch.to_pylist():
            start = row["depth"]
            if last and last["head"] == row["head"]:
                shared = common_turns(last["path"], row["path"], start)
                while stack[-1].depth > shared:
                    close()
                start = shared + 1
            else:
                while stack:
                    close()
            stack.extend(_Open(d) for d in range(start, len(row["path"]) // ID + 1))
            stack[-1].ends = row["ends"]
            stack[-1].take(row["conv"], row["n"])
            last = row
        yield _nodes(out)
        out = []
    while stack:
        close()
    yield _nodes(out)


def _nodes(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in NODE.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string(), pa.binary()]
    return pa.record_batch({n: pa.array([r[k] for r in rows], kinds[k]) for k, n in enumerate([*names, "above"])})


def sweep(containers: DataFrame) -> DataFrame:
    """Every node of the containers; ``above`` is the key of the burst node above, null but for tops."""
    dealt = containers.repartition("head").sortWithinPartitions("head", "path").select(
        "head", "path", "words", "conv", "n", "ends", "depth", "above", "up")
    return stored(dealt.mapInArrow(_sweep, NODE + ", above binary"), "nodes")


# ---- burst nodes

def _as_children(rows: DataFrame) -> DataFrame:
    """The nodes right below a burst node, as what they add to it."""
    return rows.filter("above is not null").select(
        "above", F.lit(1).cast("bigint").alias("children"), F.col("n_leaves").alias("leaves"),
        F.col("saved_tokens").alias("saved"))


def _added_up(tops: DataFrame) -> DataFrame:
    return tops.groupBy(F.col("above").alias("key")).agg(
        F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def burst_nodes(rounds: list[DataFrame], swept: DataFrame) -> list[DataFrame]:
    """The rows of the burst nodes, round by round from the last: sums over the nodes below, then along the
    chain. The lists of a round are as long as there are heads above the limit."""
    tops, out = _as_children(swept), []
    for nodes in reversed(rounds):
        known = nodes.join(_added_up(tops), "key")
        spared = F.transform("words", lambda w: (F.col("n") - 1) * w)
        known = stored(known.withColumn("spared", spared).select(
            "*", F.posexplode("spared").alias("_at", "_own")), "chains")
        size = F.size("spared")
        rest = F.slice("spared", F.col("_at") + 1, size)
        first, last = F.col("_at") == 0, F.col("_at") == size - 1
        rows = known.select(
            F.col("conv").alias("conv_id"), (F.col("top") + F.col("_at")).cast("bigint").alias("depth"),
            F.when(first, F.col("up")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
            F.when(last, F.col("children")).otherwise(1).alias("n_children"), F.col("leaves").alias("n_leaves"),
            (F.col("saved") + F.aggregate(rest, F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("saved_tokens"),
            F.when(last, F.coalesce("ends", F.lit(NOTHING))).otherwise(NOTHING).alias("ends_sha256"),
            F.when(first, F.col("above")).alias("above"))
        out.append(rows)
        tops = tops.unionByName(_as_children(rows))
    return out


def conversation_trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    A null role or text is empty; rows without conv_id are left out, other columns are not looked at. An empty
    table has no conversation and so no root.
    """
    reach_workers(conversations.sparkSession)
    containers, rounds = burst(sequences(rebuilt(conversations)), limit)
    swept = sweep(reduce(DataFrame.unionByName, containers))
    return reduce(DataFrame.unionByName, [swept, *burst_nodes(rounds, swept)]).drop("above")
