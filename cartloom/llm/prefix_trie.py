"""Prefix trie of conversations: padded matrices of turn ids, sorted and cut into nodes with numpy.

A conversation is a row of turn ids (128 bits of the SHA-256 of role and text), cut into blocks of
``WIDTH`` turns. A block knows the turns before it by the XOR of their (position, id) hashes, so blocks
at any depth are handled alike and no row is longer than a block. The blocks are dealt out by ranges
of (depth, turns before, ids, conv_id): equal and similar rows may fill many shards, as the number of
the conversation is the last key. A shard pads its ids to a matrix and lexsorts it; where a column
differs from the row above, a node starts there and in all later columns (the masks are added up
with OR); ``reduceat`` then gives the figures of all nodes of a depth. Only nodes on the path of a shard's
first or last row can go on in another shard; those partial figures, two paths per shard, are put
together afterwards.

Figures of whole subtrees come from a second pass: every node's own figure is booked on one of its
members (the smallest conv_id), at the node's depth. A subtree's sum is then the sum over the top's
members of what is booked on them from that depth on, again one ``reduceat`` per depth.

Defined results: turns come by number, null first, then by id; a null role or text is empty; rows without
conv_id belong to no conversation and are left out; repeated turns of a conversation stand one after
the other; a long text counts whole; columns besides the four are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from cartloom.llm.ranks import ranked
from cartloom.llm.shared import stored

#: Turns of a block, and digits of a turn's id.
WIDTH = 16
ID = 32
#: Rows that a shard is meant to hold; beyond ``SHARDS`` shards they hold more.
SHARD_ROWS = 65_536
SHARDS = 50_000
#: Turns that a rebuilt conversation may take from its base.
BORROWED = 9
FIVE = 5
_ROWS = "conv_id long, block long, p1 long, p2 long, path string, bytes array<long>, m1 array<long>, m2 array<long>, last boolean"
_NODES = "depth long, k1 long, k2 long, conv_id long, n_convs long, n_ends long, bytes long, partial boolean"
_WHOLE = (
    "depth long, k1 long, k2 long, q1 long, q2 long, conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends string, first long, partial boolean"
)


# --- rows


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, total, id, bytes): every turn with its position, and the number of its conversation's turns."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    slim = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id",
        "turn",
        F.substring(F.sha2(named, 256), 1, ID).alias("id"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    return ranked(slim, ["conv_id"], ["turn", "id"], "at").drop("turn")


def rebuilt(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, id, bytes) of the rebuilt conversations, and (conv_id, length) of all of them.

    A conversation c starts with the first h turns of c - c % 5 and goes on with its own after h;
    h is crc32(c) % 9.
    """

    def taken(conv: Column) -> Column:
        return F.pmod(F.crc32(conv.cast("string")), F.lit(BORROWED))

    base = F.col("conv_id") - F.col("conv_id") % FIVE
    sizes = stored(found.groupBy("conv_id").agg(F.first("total").alias("total")), "sizes")
    of_base = sizes.select(F.col("conv_id").alias("base"), F.col("total").alias("n_base"))
    convs = sizes.withColumns({"h": taken(F.col("conv_id")), "base": base}).join(of_base, "base", "left")
    convs = convs.withColumn("start", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = stored(convs.select("conv_id", "base", "h", "start", "total"), "convs")
    heads = found.where(F.col("at") < BORROWED - 1).select(F.col("conv_id").alias("base"), "at", "id", "bytes")
    borrowed = convs.where("h > 0").join(heads, "base").where("at < h").select("conv_id", "at", "id", "bytes")
    starts = convs.select("conv_id", "h", "start")
    own = found.join(starts, "conv_id").where("at >= h")
    own = own.select("conv_id", (F.col("at") - F.col("h") + F.col("start")).alias("at"), "id", "bytes")
    length = F.col("start") + F.greatest(F.col("total") - F.col("h"), F.lit(0))
    return borrowed.unionAll(own), convs.select("conv_id", length.alias("length"))


def blocks(ordered: DataFrame, lengths: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows of at most ``width`` turns, with the XOR of all turns before them."""
    marks = {name: F.xxhash64(F.lit(n), "at", "id") for n, name in enumerate(("m1", "m2"))}
    held = ordered.withColumns({"block": F.floor(F.col("at") / width).cast("long"), **marks})
    held = held.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("at", "id", "bytes", "m1", "m2"))).alias("turns"),
        F.bit_xor("m1").alias("x1"),
        F.bit_xor("m2").alias("x2"),
    )
    bare = lengths.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("block"))
    held = held.unionByName(bare, allowMissingColumns=True)
    order = Window.partitionBy("conv_id").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return held.select(
        "conv_id",
        "block",
        *[F.coalesce(F.bit_xor(f"x{n}").over(before), F.lit(0).cast("long")).alias(f"p{n}") for n in (1, 2)],
        F.coalesce(F.array_join("turns.id", ""), F.lit("")).alias("path"),
        *[F.coalesce(f"turns.{name}", F.array().cast("array<long>")).alias(name) for name in ("bytes", "m1", "m2")],
        F.lead("block").over(order).isNull().alias("last"),
    )


# --- a shard


class Shard:
    """The rows of a shard as padded matrices, in lexicographic order."""

    def __init__(self, table: pa.Table, width: int):
        self.width, size = width, table.num_rows
        number = {name: table.column(name).to_numpy() for name in ("conv_id", "block", "p1", "p2")}
        paths = table.column("path").to_pylist()
        lengths = np.fromiter(map(len, paths), np.int64, size) // ID
        held = np.arange(width) < lengths[:, None]
        lanes = np.frombuffer(bytes.fromhex("".join(paths)), ">u8").astype(np.uint64).reshape(-1, 2)
        ids = [_padded(lane, held) for lane in lanes.T]
        keys = [number["conv_id"]]
        for column in range(width - 1, -1, -1):
            keys += [ids[1][:, column], ids[0][:, column]]
        order = np.lexsort([*keys, number["p2"], number["p1"], number["block"]])
        self.order, self.lengths = order, lengths[order]
        self.conv, self.block = number["conv_id"][order], number["block"][order]
        self.ends = table.column("last").to_numpy(zero_copy_only=False)[order]
        self.bytes = _padded(_flat(table, "bytes"), held)[order]
        # Where a row leaves the one above: in its first column, and from there on in all.
        changed = np.ones((size, width + 1), bool)
        changed[1:, 0] = np.any([np.diff(number[name][order]) != 0 for name in ("block", "p1", "p2")], axis=0)
        changed[1:, 1:] = np.any([np.diff(lane[order], axis=0) != 0 for lane in ids], axis=0)
        self.starts = np.logical_or.accumulate(changed, axis=1)
        self.keys = []
        for name, marks in (("p1", "m1"), ("p2", "m2")):
            first = number[name][:, None]
            self.keys.append(np.bitwise_xor.accumulate(np.hstack([first, _padded(_flat(table, marks), held)]), axis=1)[order])

    def depths(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Column, the rows that reach it, and where among these its nodes start. The root is in block 0 alone."""
        for column in range(self.width + 1):
            rows = np.nonzero(self.lengths >= column if column else self.block == 0)[0]
            if len(rows):
                yield column, rows, np.nonzero(self.starts[rows, column])[0]

    def figures(self, column: int, rows: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """What both passes say of the nodes of a column."""
        tops = rows[starts]
        partial = np.zeros(len(starts), bool)
        partial[0] = rows[0] == 0
        partial[-1] |= rows[-1] == len(self.conv) - 1
        return {
            "depth": self.block[tops] * self.width + column,
            "k1": self.keys[0][tops, column],
            "k2": self.keys[1][tops, column],
            "conv_id": np.minimum.reduceat(self.conv[rows], starts),
            "n_convs": np.diff(np.append(starts, len(rows))),
            "partial": partial,
        }

    def ending(self, column: int, rows: np.ndarray) -> np.ndarray:
        return self.ends[rows] & (self.lengths[rows] == column)


def _padded(values: np.ndarray, held: np.ndarray) -> np.ndarray:
    out = np.zeros(held.shape, values.dtype)
    out[held] = values
    return out


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return pc.list_flatten(table.column(name)).to_numpy()


def _dealt(rows: DataFrame, shards: int | None) -> DataFrame:
    if shards is None:
        least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shards = min(SHARDS, max(least, rows.count() // SHARD_ROWS))
    return rows.repartitionByRange(shards, "block", "p1", "p2", "path", "conv_id")


def _shard(batches: Iterator[pa.RecordBatch], width: int) -> tuple[pa.Table, Shard] | None:
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return None
    table = pa.Table.from_batches(held)
    return table, Shard(table, width)


def _batch(found: dict[str, np.ndarray | pa.Array], schema: str) -> pa.RecordBatch:
    names = [field.split()[0] for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(found[name]) for name in names], names)


# --- passes


def nodes(rows: DataFrame, width: int = WIDTH, shards: int | None = None) -> DataFrame:
    """Every node once: its key, members, members that end in it, bytes of its last text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (held := _shard(batches, width)) is None:
            return
        shard = held[1]
        for column, members, starts in shard.depths():
            found = shard.figures(column, members, starts)
            found["n_ends"] = np.add.reduceat(shard.ending(column, members).astype(np.int64), starts)
            size = len(starts)
            found["bytes"] = shard.bytes[members[starts], column - 1] if column else np.zeros(size, np.int64)
            yield _batch(found, _NODES)

    found = stored(_dealt(rows, shards).mapInArrow(run, _NODES), "nodes")
    key = ["depth", "k1", "k2"]
    shared = found.where("partial").groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_ends").alias("n_ends"),
        F.max("bytes").alias("bytes"),
    )
    return found.where("not partial").drop("partial").unionByName(shared)


def booked(rows: DataFrame, found: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows with what is booked on them: per depth, and the sums of all later blocks.

    Booked on a node's smallest conv_id: the bytes that it saves, and whether it is a leaf.
    """
    place = F.when(F.col("depth") == 0, 0).otherwise(F.floor((F.col("depth") - 1) / width)).cast("long")
    own = found.select(
        "conv_id",
        place.alias("block"),
        (F.col("depth") - place * width).alias("column"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaf"),
    )
    own = own.groupBy("conv_id", "block").agg(
        F.collect_list(F.struct("column", "saved", "leaf")).alias("booked"),
        F.sum("saved").alias("own_saved"),
        F.sum("leaf").alias("own_leaves"),
        F.max((F.col("column") == 1).cast("long")).alias("opens"),
    )
    joined = rows.join(own, ["conv_id", "block"], "left")
    order = Window.partitionBy("conv_id").orderBy("block")
    later = order.rowsBetween(1, Window.unboundedFollowing)
    none = F.lit(0).cast("long")
    return joined.select(
        *rows.columns,
        *[F.coalesce(f"booked.{n}", F.array().cast("array<long>")).alias(f"booked_{n}") for n in ("column", "saved", "leaf")],
        F.coalesce(F.sum("own_saved").over(later), none).alias("later_saved"),
        F.coalesce(F.sum("own_leaves").over(later), none).alias("later_leaves"),
        F.coalesce(F.lead("opens").over(order), none).alias("later_opens"),
    )


def subtrees(rows: DataFrame, width: int = WIDTH, shards: int | None = None) -> DataFrame:
    """Every node with the figures of its subtree; those of nodes that several shards share are not summed yet.

    ``ends``: the digest of the ids of the members that end in a node, or, where it is shared, the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (held := _shard(batches, width)) is None:
            return
        table, shard = held
        at = np.repeat(np.arange(table.num_rows), pc.list_value_length(table.column("booked_column")).to_numpy())
        columns = _flat(table, "booked_column")

        def per_column(values: np.ndarray, later: str, extra: int = 0) -> np.ndarray:
            out = np.zeros((table.num_rows, width + 1 + extra), np.int64)
            np.add.at(out, (at, columns), values)
            out[:, -1] += table.column(later).to_numpy()
            return out[shard.order]

        saved = per_column(_flat(table, "booked_saved"), "later_saved")
        leaves = per_column(_flat(table, "booked_leaf"), "later_leaves")
        opened = per_column(np.ones(len(at), np.int64), "later_opens", 1)
        saved, leaves = (np.cumsum(values[:, ::-1], axis=1)[:, ::-1] for values in (saved, leaves))
        for column, members, starts in shard.depths():
            found = shard.figures(column, members, starts)
            above = max(column - 1, 0)
            for lane in (0, 1):
                found[f"q{lane + 1}"] = shard.keys[lane][members[starts], above]
            for name, values in (("saved_tokens", saved[:, column]), ("n_leaves", leaves[:, column]), ("n_children", opened[:, column + 1])):
                found[name] = np.add.reduceat(values[members], starts)
            ending = shard.ending(column, members)
            counts = np.add.reduceat(ending.astype(np.int64), starts)
            ids = shard.conv[members[ending]]
            found["ends"], found["first"] = _ends(ids, counts, found["partial"])
            yield _batch(found, _WHOLE)

    return _dealt(rows, shards).mapInArrow(run, _WHOLE)


def _ends(ids: np.ndarray, counts: np.ndarray, partial: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Per node: the digest of its ids, or the ids themselves where it is shared; the first id."""
    cuts = np.cumsum(counts) - counts
    texts, firsts, nothing = [], [], _digest(b"")
    for start, count, shared in zip(cuts.tolist(), counts.tolist(), partial.tolist()):
        if not count:
            texts.append("" if shared else nothing)
            firsts.append(None)
            continue
        joined = ",".join(map(str, ids[start : start + count].tolist()))
        texts.append(joined if shared else _digest(joined.encode()))
        firsts.append(int(ids[start]))
    return pa.array(texts, pa.string()), pa.array(firsts, pa.int64())


def _digest(value: bytes) -> str:
    return hashlib.sha256(value).hexdigest()


def _joined_digests(pieces: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends): digest of all pieces of a node, one after the other; one piece is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            for depth, k1, k2, ends in zip(*(batch.column(name).to_pylist() for name in ("depth", "k1", "k2", "ends"))):
                if (depth, k1, k2) != now:
                    if now is not None:
                        yield _named(now, state)
                    now, state = (depth, k1, k2), hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
        if now is not None:
            yield _named(now, state)

    key = ["depth", "k1", "k2"]
    held = pieces.repartition(*key).sortWithinPartitions(*key, "first").select(*key, "ends")
    return held.mapInArrow(run, "depth long, k1 long, k2 long, ends string")


def _named(key: tuple[int, int, int], state: hashlib._Hash) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"depth": [key[0]], "k1": [key[1]], "k2": [key[2]], "ends": [state.hexdigest()]}
    )


def whole(found: DataFrame) -> DataFrame:
    """Every node once, shared ones put together."""
    key = ["depth", "k1", "k2"]
    sums = [F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parents = [F.max(name).alias(name) for name in ("q1", "q2")]
    shared = found.where("partial")
    summed = shared.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), *parents, *sums)
    ends = _joined_digests(shared.where("first is not null"))
    summed = summed.join(ends, key, "left").withColumn("ends", F.coalesce("ends", F.lit(_digest(b""))))
    return found.where("not partial").drop("partial", "first").unionByName(summed)


def trie(conversations: DataFrame, width: int = WIDTH, shards: int | None = None) -> DataFrame:
    """Every node of the trie of the rebuilt conversations, named by its smallest conversation and its depth."""
    ordered, lengths = rebuilt(stored(turns(conversations), "turns"))
    rows = stored(blocks(ordered, lengths, width), "blocks")
    own = stored(nodes(rows, width, shards), "nodes")
    found = whole(stored(subtrees(booked(rows, own, width), width, shards), "subtrees"))
    parents = own.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("q1"),
        F.col("k2").alias("q2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return found.join(parents, ["depth", "q1", "q2"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.col("ends").alias("ends_sha256"),
    )
