"""Near-duplicate vectors by spherical-cap filters from structured random product codes.

A code turns the vectors by a random rotation, cuts them into blocks and has a few random directions
per block; every combination of one direction per block is a filter. The directions of a filter need
never be listed: the best combinations of a vector are found block by block. A vector's cap is as
wide as brings it to ``PER_CODE`` filters, and it is decoded to all filters that exceed that bound. (With
one bound for all vectors, product codes give some vectors hundreds of filters and others none:
at a cosine of 0.95, 16 filters on average then find 0.4 to 0.8 of the pairs instead of 0.99.) Two vectors
meet where they share a filter; what meets is verified by the cosine in double precision.

Dense groups are not paired out. Vectors within half the angle of a link from a centre form a
cluster: all its members are linked with one another, by the triangle inequality. Clusters stand in
the filters of their members, once each. Two that meet are compared by the angle of their centres,
less or more their radii: it links all their members, or none, or leaves the pair open; only open pairs are compared
member by member, in blocks. So every pair that shares a filter is decided exactly, and a group of n
near copies costs n rows.

Before vectors travel, 128 signs of random projections tell apart what is far from a link: the
limit is six standard errors beyond what the angle of a link gives.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing; vectors of different lengths are never linked; repeated rows are linked like any others, also
where they share a vec_id; a null vec_id names no component unless all its members have none; columns
besides the two are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cartloom.llm.components import components
from cartloom.llm.shared import stored

COSINE = 0.95
#: Codes, and filters of a vector in each of them; four more for every tenfold of ``FIRST`` vectors.
CODES = 2
PER_CODE = 8
FIRST = 100_000
#: Vectors per filter that a code is made for, were they spread evenly; directions of a block at most.
BUCKET = 8
DIRECTIONS = 48
SIGNS = 128
SEED = 20
#: Kept from bounds on angles for rounding.
SLACK = 1e-7
#: Rounds that join vectors to centres, and members of a cluster that are compared at a time.
ROUNDS = 3
BLOCK = 16


def per_code(count: int) -> int:
    return PER_CODE + max(0, math.ceil(4 * math.log10(max(count, 1) / FIRST)))


class Code:
    """A product code over vectors of one length."""

    def __init__(self, length: int, count: int, number: int):
        rng = np.random.default_rng([SEED, length, number])
        self.keep = per_code(count)
        wanted = max(self.keep * count / BUCKET, 2.0)
        blocks = min(length, max(1, math.ceil(math.log(wanted) / math.log(DIRECTIONS))))
        size = max(2, math.ceil(wanted ** (1 / blocks)))
        self.turn = np.linalg.qr(rng.normal(size=(length, length)))[0]
        self.cuts = np.linspace(0, length, blocks + 1).round().astype(int)
        self.directions = []
        for start, end in zip(self.cuts, self.cuts[1:]):
            found = rng.normal(size=(size, end - start))
            self.directions.append(found / np.linalg.norm(found, axis=1, keepdims=True))

    def decode(self, unit: np.ndarray) -> np.ndarray:
        """Numbers of the best filters of every unit vector, one row each.

        The best sums over some blocks are made of the best sums over all but the last of them.
        """
        turned, rows = unit @ self.turn, len(unit)
        total, found = np.zeros((rows, 1)), np.zeros((rows, 1), np.int64)
        for start, end, directions in zip(self.cuts, self.cuts[1:], self.directions):
            scores = turned[:, start:end] @ directions.T
            best = _best(scores, self.keep)
            sums = total[:, :, None] + np.take_along_axis(scores, best, 1)[:, None, :]
            names = found[:, :, None] * len(directions) + best[:, None, :]
            sums, names = sums.reshape(rows, -1), names.reshape(rows, -1)
            best = _best(sums, self.keep)
            total, found = np.take_along_axis(sums, best, 1), np.take_along_axis(names, best, 1)
        return found


def _best(scores: np.ndarray, keep: int) -> np.ndarray:
    if scores.shape[1] <= keep:
        return np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    return np.argpartition(-scores, keep - 1, axis=1)[:, :keep]


@lru_cache(maxsize=64)
def codes(length: int, count: int) -> tuple[list[Code], np.ndarray]:
    """The codes for ``count`` vectors of a length, and the projections whose signs are kept."""
    signs = np.random.default_rng([SEED, length]).normal(size=(length, SIGNS))
    return [Code(length, count, number) for number in range(CODES)], signs


def filters(unit: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Filters of unit vectors (with length and code in their numbers), and 128 signs as two integers."""
    length = unit.shape[1]
    made, signs = codes(length, count)
    found = [(np.int64(length * CODES + n) << 44) + code.decode(unit) for n, code in enumerate(made)]
    bits = np.packbits(unit @ signs > 0, axis=1).view(">i8").astype(np.int64)
    return np.hstack(found), bits


def units(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the vectors of each length that have a direction, and their unit vectors in double precision."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.nonzero(lengths == length)[0]
        values = flat[starts[rows][:, None] + np.arange(length)]
        most = np.abs(values).max(1)
        good = np.isfinite(most) & (most > 0)
        values = values[good] / most[good][:, None]
        if len(values):
            yield rows[good], values / np.linalg.norm(values, axis=1, keepdims=True)


def decoded(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Stored rows of row, vec_id, unit (array of doubles), filters, s1 and s2; the last four null for vectors without
    a direction."""
    slim = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    slim = slim.withColumn("row", F.monotonically_increasing_id())
    counts = {row[0]: row[1] for row in slim.groupBy(F.size("vector")).count().collect()}
    schema = "row long, vec_id long, unit array<double>, filters array<long>, s1 long, s2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                rows, names = batch.column("row"), batch.column("vec_id")
                left = np.ones(batch.num_rows, bool)
                for at, unit in units(batch.column("vector")):
                    left[at] = False
                    found, bits = filters(unit, counts[unit.shape[1]])
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays(
                        [rows.take(take), names.take(take), _lists(unit), _lists(found), pa.array(bits[:, 0]), pa.array(bits[:, 1])],
                        ["row", "vec_id", "unit", "filters", "s1", "s2"],
                    )
                take = pa.array(np.nonzero(left)[0])
                none = [pa.nulls(len(take), pa.list_(pa.float64())), pa.nulls(len(take), pa.list_(pa.int64()))]
                none += [pa.nulls(len(take), pa.int64())] * 2
                yield pa.RecordBatch.from_arrays(
                    [rows.take(take), names.take(take), *none], ["row", "vec_id", "unit", "filters", "s1", "s2"]
                )

    return stored(slim.mapInArrow(run, schema), "filters")


def _lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def _apart(left: str, right: str) -> Column:
    """Signs in which two rows differ."""
    return sum(F.bit_count(F.col(f"{left}.s{n}").bitwiseXOR(F.col(f"{right}.s{n}"))) for n in (1, 2))


def _limit(angle: Column) -> Column:
    """Differing signs that two vectors at an angle hardly ever exceed."""
    share = F.least(angle / math.pi, F.lit(0.5))
    return F.ceil(SIGNS * share + 6 * F.sqrt(SIGNS * share * (1 - share))).cast("int")


# --- clusters


def _angles(pairs: DataFrame, vectors: DataFrame, left: str, right: str) -> DataFrame:
    """The pairs of rows with the cosine of their vectors."""
    names = pairs.columns
    found = pairs.join(vectors.select(F.col("row").alias(left), F.col("unit").alias("unit_a")), left)
    found = found.join(vectors.select(F.col("row").alias(right), F.col("unit").alias("unit_b")), right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            a, b = ([np.asarray(v) for v in _views(batch.column(name))] for name in ("unit_a", "unit_b"))
            for at, (one, other) in enumerate(zip(a, b)):
                out[at] = one @ other
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in names), pa.array(out)], [*names, "cosine"])

    schema = T.StructType([*pairs.schema.fields]).add("cosine", "double")
    return found.select(*names, "unit_a", "unit_b").mapInArrow(run, schema)


def _views(column: pa.Array) -> list[np.ndarray]:
    flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
    return np.split(flat, np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))[:-1]) if len(column) else []


def clusters(found: DataFrame, angle: float) -> DataFrame:
    """(row, centre, apart): vectors within half of ``angle`` of a centre, the centres among them.

    Every filter offers its first vector as a centre, one that is a centre already before others. A
    vector takes the first one near enough of those that its filters offer. A centre that has itself
    taken another is none; those that chose it choose again.
    """
    near = angle / 2 - SLACK
    bound = _limit(F.lit(near))
    vectors = found.where("filters is not null")
    loose = vectors.select("row", "filters", "s1", "s2", F.lit(False).alias("centre"))
    members = None
    for _ in range(ROUNDS):
        spread = loose.select("row", "s1", "s2", "centre", F.explode("filters").alias("filter"))
        first = F.min(F.struct((~F.col("centre")).alias("other"), "row", "s1", "s2")).alias("first")
        offers = spread.groupBy("filter").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1")
        offers = stored(offers.select("filter", "first.*"), "offers").alias("o")
        own = spread.where("not centre").alias("v")
        chosen = own.join(offers, "filter").where((F.col("v.row") != F.col("o.row")) & (_apart("v", "o") <= bound))
        chosen = chosen.where(~F.col("o.other") | (F.col("o.row") < F.col("v.row")))
        chosen = chosen.groupBy(F.col("v.row").alias("row")).agg(F.min(F.struct("o.other", "o.row")).alias("best"))
        chosen = stored(chosen.select("row", F.col("best.row").alias("centre")), "chosen")
        taken = _angles(chosen, vectors, "row", "centre").where(F.col("cosine") >= math.cos(near))
        taken = stored(taken.select("row", "centre", F.acos(F.least("cosine", F.lit(1.0))).alias("apart")), "taken")
        joined = taken.join(taken.select(F.col("row").alias("centre")), "centre", "left_anti").select(*taken.columns)
        joined = stored(joined, "joined")
        members = joined if members is None else members.unionAll(joined)
        left = stored(taken.join(joined.select("row"), "row", "left_anti").select("row"), "left")
        if left.isEmpty():
            break
        centres = members.select(F.col("centre").alias("row")).distinct()
        again = left.select("row", F.lit(False).alias("centre")).unionAll(centres.select("row", F.lit(True).alias("centre")))
        loose = vectors.select("row", "filters", "s1", "s2").join(again, "row")
    centres = members.select(F.col("centre").alias("row")).distinct()
    return stored(members.unionAll(centres.select("row", F.col("row").alias("centre"), F.lit(0.0).alias("apart"))), "members")


def meetings(found: DataFrame, members: DataFrame, angle: float) -> DataFrame:
    """(a, b): clusters, and vectors that are in none, that share a filter and may be linked; each pair once."""
    signs = found.select(F.col("row").alias("centre"), "s1", "s2")
    sizes = members.groupBy("centre").agg(F.max("apart").alias("radius"))
    named = sizes.join(signs, "centre")
    placed = members.select("row", "centre").join(named, "centre").select("row", "centre", "radius", "s1", "s2")
    vectors = found.where("filters is not null").select("row", "filters", "s1", "s2")
    own = stored(placed.join(vectors.select("row", "filters"), "row"), "placed")
    kept = ["filter", "item", "s1", "s2", "far"]
    far = _limit(F.lit(angle) + 2 * F.col("radius")).alias("far")
    dense = own.select(F.explode("filters").alias("filter"), F.col("centre").alias("item"), "s1", "s2", far).distinct()
    single = vectors.join(members.select("row"), "row", "left_anti")
    single = single.withColumn("radius", F.lit(0.0)).select(
        F.explode("filters").alias("filter"), F.col("row").alias("item"), "s1", "s2", far
    )
    spread = single.select(*kept).unionAll(dense.select(*kept))
    a, b = spread.alias("a"), spread.alias("b")
    pairs = a.join(b, (F.col("a.filter") == F.col("b.filter")) & (F.col("a.item") < F.col("b.item")))
    pairs = pairs.where(_apart("a", "b") <= F.greatest("a.far", "b.far"))
    return stored(pairs.select(F.col("a.item").alias("a"), F.col("b.item").alias("b")).distinct(), "meetings")


# --- links


def _blocks(vectors: DataFrame, members: DataFrame, wanted: DataFrame) -> DataFrame:
    """(item, rows, units): the members of the wanted clusters in blocks; a vector in none is a block of its own."""
    placed = wanted.join(members.select(F.col("centre").alias("item"), "row"), "item", "left")
    placed = placed.select("item", F.coalesce("row", "item").alias("row"))
    sizes = placed.groupBy("item").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = placed.join(sizes, "item").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")))
    dealt = dealt.join(vectors.select("row", "unit"), "row")
    held = dealt.groupBy("item", "block").agg(F.collect_list(F.struct("row", "unit")).alias("held"))
    return stored(held.select("item", F.col("held.row").alias("rows"), F.flatten("held.unit").alias("units")), "blocks")


def _counted(both: DataFrame, cosine: float) -> DataFrame:
    """(a, b, row, n): members of open pairs with the number of their links in the other block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name) for name in ("rows_a", "units_a", "rows_b", "units_b")]
            parts = zip(*(_views(column) for column in columns))
            for a, b, (rows_a, units_a, rows_b, units_b) in zip(
                batch.column("a").to_pylist(), batch.column("b").to_pylist(), parts
            ):
                linked = units_a.reshape(len(rows_a), -1) @ units_b.reshape(len(rows_b), -1).T >= cosine
                rows = np.concatenate([rows_a, rows_b])
                counts = np.concatenate([linked.sum(1), linked.sum(0)])
                rows, counts = rows[counts > 0], counts[counts > 0]
                if len(rows):
                    names = [np.full(len(rows), name, np.int64) for name in (a, b)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(column) for column in (*names, rows.astype(np.int64), counts.astype(np.int64))],
                        ["a", "b", "row", "n"],
                    )

    return both.mapInArrow(run, "a long, b long, row long, n long")


def linked(found: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links and component_id of every decoded row."""
    angle = math.acos(cosine)
    vectors = found.where("filters is not null")
    members = clusters(found, angle)
    sizes = stored(
        members.groupBy("centre").agg(F.max("apart").alias("radius"), F.count(F.lit(1)).alias("n")), "clusters"
    )
    pairs = _angles(meetings(found, members, angle), vectors, "a", "b")
    for name in ("a", "b"):
        of = sizes.select(
            F.col("centre").alias(name), F.col("radius").alias(f"radius_{name}"), F.col("n").alias(f"n_{name}")
        )
        pairs = pairs.join(of, name, "left").fillna({f"radius_{name}": 0.0, f"n_{name}": 1})
    between, reach = F.acos(F.greatest(F.least("cosine", F.lit(1.0)), F.lit(-1.0))), F.col("radius_a") + F.col("radius_b")
    single = (F.col("n_a") == 1) & (F.col("n_b") == 1)
    kind = (
        F.when(single, F.when(F.col("cosine") >= cosine, "all"))
        .when(between + reach <= angle - SLACK, "all")
        .when(between - reach <= angle + SLACK, "open")
    )
    pairs = stored(pairs.withColumn("kind", kind).where("kind is not null"), "pairs")
    unclear = pairs.where("kind = 'open'").select("a", "b")
    wanted = unclear.select(F.explode(F.array("a", "b")).alias("item")).distinct()
    blocks = _blocks(vectors, members, wanted)
    both = unclear
    for name in ("a", "b"):
        of = blocks.select(F.col("item").alias(name), F.col("rows").alias(f"rows_{name}"), F.col("units").alias(f"units_{name}"))
        both = both.join(of, name)
    some = stored(_counted(both, cosine), "counted")
    full = pairs.where("kind = 'all'")
    edges = full.select("a", "b").unionAll(some.select("a", "b").distinct())
    roots = components(edges.select(F.col("a").alias("key"), F.col("b").alias("root")))
    whole = full.select(F.col("a").alias("item"), F.col("n_b").alias("n"))
    whole = whole.unionAll(full.select(F.col("b").alias("item"), F.col("n_a").alias("n")))
    whole = whole.unionAll(sizes.select(F.col("centre").alias("item"), (F.col("n") - 1).alias("n")))
    whole = whole.groupBy("item").agg(F.sum("n").alias("n_all"))
    own = some.groupBy("row").agg(F.sum("n").alias("n_some"))
    rows = found.select("row", "vec_id").join(members.select("row", "centre"), "row", "left")
    rows = rows.select("row", "vec_id", F.coalesce("centre", "row").alias("item"))
    rows = rows.join(roots.withColumnRenamed("key", "item"), "item", "left").join(whole, "item", "left").join(own, "row", "left")
    n_links = F.coalesce("n_all", F.lit(0)) + F.coalesce("n_some", F.lit(0))
    rows = stored(
        rows.select("vec_id", F.coalesce("root", "item").alias("name"), n_links.cast("long").alias("n_links")), "rows"
    )
    least = stored(rows.groupBy("name").agg(F.min("vec_id").alias("component_id")), "least")
    return rows.join(least, "name").select("vec_id", "n_links", "component_id")


def report(vectors: DataFrame) -> DataFrame:
    """Every vector's number of links, its component, and whether it stands for it."""
    found = linked(decoded(vectors))
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
