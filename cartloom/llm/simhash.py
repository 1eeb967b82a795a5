"""SimHash near-duplicates: a binary trie of fingerprints joined with itself.

A fingerprint has a bit set where more than half of the text's shingle hashes have it. Two of them
within ``budget`` bits of each other have, among ``parts`` groups of bits, one group within
``budget // parts`` bits. So there is one trie per group, with that group's bits on top: pairs of
nodes go down together, their differing bits add up, and a pair ends when it exceeds the smaller
budget within the group or the whole one below it. Every linked pair is found by one of the tries.

The pipeline's stage takes close fingerprints as hints only: texts connected by them are a family, and
within a family texts are linked by the exact Jaccard of their sets of shingles (``deduplicated``).
With as many differing bits as that needs, top nodes would meet the more guests the more texts there
are. There the tries are dealt by buckets instead: a text is in one bucket for each of a few least hashes of
its set of shingles, and each bucket has a trie of its own (``links`` with ``by``).

The trie is the sorted list of distinct fingerprints: a node is a range of it. Its top levels
(as many as bring a node to about ``NODE`` fingerprints) deal the work out: a task gets one top node with its own fingerprints and those of the higher nodes
whose prefixes fit the budget. Tasks return for each of their classes links to its smallest member
only, so a dense group of n fingerprints costs n links. Links are joined to classes by star rounds
(``components``).

Defined results: null texts and texts without words have fingerprint zero and are linked like any
other; shorter texts have one shingle, the whole sequence; rows of equal text share a class; a null
doc_id is never a class's name unless the class has no other; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from cartloom.llm.components import components as classes
from cartloom.llm.shared import as_bytes, free_names, slices, stored

SHINGLE = 4
BUDGET = 4
#: Fingerprints that a top node of a trie is meant to hold; the levels above it follow from their number.
NODE = 65_536
SEED = 42
#: Node pairs that a task expands at a time, and leaf pairs that a node pair may have to be compared at once.
FRONT = 200_000
SMALL = 16
#: Shingles of the texts that a task compares with one another, or of each of two blocks of a larger family.
BLOCK = 1 << 20
#: Buckets of a text, and orders of its set of shingles whose least members together name one. Two texts
#: of Jaccard 0.8 share one of two orders in 0.64 of all cases, and miss all ten in 0.00004.
BANDS = 10
ORDERS = 2


def _majority(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def shingles(text: bytes, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; of the whole sequence if that is shorter."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    count = max(1, len(words) - size + 1)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[: count - 1]]).tolist()
    stops = (ends[min(size, len(words)) - 1 :][:count] - 1).tolist()
    return np.fromiter([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], np.uint64, count)


def fingerprint(text: bytes, size: int = SHINGLE, more: bool = False) -> tuple[int, int]:
    """The fingerprint, and 64 more bits (from the same hashes, spread again) if asked for."""
    return _bits(shingles(text, size), more)


def _bits(hashes: np.ndarray, more: bool) -> tuple[int, int]:
    if not len(hashes):
        return 0, 0
    return _majority(hashes), _majority(_spread(hashes)) if more else 0


def _spread(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


#: Odd numbers: a hash times one of them is its place in one of the orders.
_PLACES = _spread(np.arange(1, BANDS * ORDERS + 1, dtype=np.uint64)) | np.uint64(1)


def bands(hashes: np.ndarray) -> np.ndarray:
    """Names of the buckets of a set of shingles: of each, its least members in ``ORDERS`` orders."""
    least = np.full(len(_PLACES), ~np.uint64(0))
    for at in range(0, len(hashes), 8192):
        least = np.minimum(least, (hashes[at : at + 8192] * _PLACES[:, None]).min(1))
    names = np.zeros(BANDS, np.uint64)
    for part in least.reshape(ORDERS, BANDS):
        names = _spread(names * np.uint64(31) + part)
    return names


def fingerprints(docs: DataFrame, size: int = SHINGLE, more: bool = False) -> DataFrame:
    """doc_id, the fingerprint (fp) and its further bits (tail) as signed 64-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [fingerprint(text, size, more) for text in as_bytes(batch.column("text"))]
            fp, tail = (np.array(column, np.uint64).view(np.int64) for column in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(fp), pa.array(tail)], ["doc_id", "fp", "tail"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long, tail long")


# --- in a task: one top node against itself and its guests


def _rotated(values: np.ndarray, by: int) -> np.ndarray:
    """The bits of a group moved to the top."""
    by %= 64
    return values if not by else (values << np.uint64(by)) | (values >> np.uint64(64 - by))


class _Sets:
    """Classes of numbered items, named by their smallest member."""

    def __init__(self, count: int):
        self.label = np.arange(count)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.label[a], self.label[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                break
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while True:  # let every label point to a root
                shorter = self.label[self.label]
                if np.array_equal(shorter, self.label):
                    break
                self.label = shorter


def trie_links(
    values: np.ndarray,
    tails: np.ndarray,
    own: np.ndarray,
    top: int,
    inner: int,
    budget: int,
    whole: int,
    start: int,
) -> np.ndarray:
    """Class label per item after joining own items with one another and with guests.

    ``values``: sorted fingerprints, group bits on top; ``tails``: their further bits; ``own``:
    whether an item belongs to this node. ``top``: bits of the group, ``inner``: budget in them;
    ``whole``: budget of fingerprint and further bits together; ``start``: levels that all own
    items share. A node is a range of the sorted items; guests and own items are never in one node
    at level ``start``, as guests have other prefixes.
    """
    size = len(values)
    edges = np.nonzero(np.diff(values >> np.uint64(64 - start)))[0] + 1 if start else np.array([], int)
    lows = np.concatenate([[0], edges]).astype(np.int64)
    highs = np.concatenate([edges, [size]]).astype(np.int64)
    home = int(np.nonzero(own[lows])[0][0])
    first = np.full(len(lows), lows[home]), np.full(len(lows), highs[home])
    prefix = values[lows] >> np.uint64(64 - start) if start else np.zeros(len(lows), np.uint64)
    spent = np.bitwise_count(prefix ^ prefix[home]).astype(np.int8)
    fits = spent <= inner
    pairs = start, first[0][fits], first[1][fits], lows[fits], highs[fits], spent[fits]
    return _descend(values, tails, pairs, top, inner, budget, whole)


def _descend(
    values: np.ndarray, tails: np.ndarray, pairs: tuple, top: int, inner: int, budget: int, whole: int
) -> np.ndarray:
    """Class label per item after taking pairs of nodes (level, ranges a:b and c:d, bits spent) down to their leaves."""
    sets, stack = _Sets(len(values)), [pairs]
    cumulated: dict[int, np.ndarray] = {}

    def ones_before(level: int) -> np.ndarray:
        if level not in cumulated:
            bits = (values >> np.uint64(63 - level)) & np.uint64(1)
            cumulated[level] = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
        return cumulated[level]

    while stack:
        level, a, b, c, d, spent = stack.pop()
        # Small node pairs: compare their leaves. Classes that are one already need no comparing.
        if level == 64:  # equal fingerprints: nodes of any size
            a, b, c, d, spent = _apart(sets.label, a, b, c, d, spent)
        small = (b - a) * (d - c) <= SMALL if level < 64 else np.ones(len(a), bool)
        if small.any():
            _compare_leaves(values, tails, sets, a[small], b[small], c[small], d[small], budget, whole)
            keep = ~small
            a, b, c, d, spent = a[keep], b[keep], c[keep], d[keep], spent[keep]
        if not len(a):
            continue
        if level % 4 == 0 and len(a) > 1000:
            a, b, c, d, spent = _apart(sets.label, a, b, c, d, spent)
        ones = ones_before(level)
        middle, centre = b - (ones[b] - ones[a]), d - (ones[d] - ones[c])
        same = (a == c) & (b == d)
        other = ~same
        limit = inner if level < top else budget
        step = spent + 1
        grown = step <= limit
        parts = [
            (a, middle, c, centre, spent, None),
            (middle, b, centre, d, spent, None),
            (a, middle, centre, d, step, grown),
            (middle, b, c, centre, step, grown & other),  # a node with itself: one of the two
        ]
        joined = []
        for la, lb, lc, ld, cost, allowed in parts:
            use = (la < lb) & (lc < ld)
            if allowed is not None:
                use &= allowed
            joined.append((la[use], lb[use], lc[use], ld[use], cost[use]))
        found = [np.concatenate(column) for column in zip(*joined)]
        for at in range(0, len(found[0]), FRONT):
            stack.append((level + 1, *[column[at : at + FRONT] for column in found]))
    return sets.label


def _apart(label: np.ndarray, a, b, c, d, spent) -> tuple[np.ndarray, ...]:
    """The node pairs that are not of one class."""
    ends = np.concatenate([[0], np.cumsum(np.diff(label) != 0)])
    one = (ends[b - 1] == ends[a]) & (ends[d - 1] == ends[c]) & (label[a] == label[c])
    return tuple(part[~one] for part in (a, b, c, d, spent))


def _compare_leaves(values, tails, sets, a, b, c, d, budget, whole) -> None:
    wide = d - c
    stops = np.cumsum((b - a) * wide)
    starts = stops - (b - a) * wide
    for at in range(0, int(stops[-1]) if len(stops) else 0, FRONT):
        place = np.arange(at, min(at + FRONT, stops[-1]))
        pair = np.searchsorted(stops, place, side="right")
        place -= starts[pair]
        left = a[pair] + place // wide[pair]
        right = c[pair] + place % wide[pair]
        apart = np.bitwise_count(values[left] ^ values[right])
        near = (left != right) & (apart <= budget)
        left, right, apart = left[near], right[near], apart[near]
        near = apart + np.bitwise_count(tails[left] ^ tails[right]) <= whole
        sets.link(left[near], right[near])


def near_prefixes(levels: int, inner: int) -> list[int]:
    """All numbers of ``levels`` bits with at most ``inner`` ones."""
    return [value for value in range(1 << levels) if value.bit_count() <= inner]


def links(
    distinct: DataFrame,
    budget: int = BUDGET,
    parts: int = 2,
    whole: int = 64,
    levels: int | None = None,
    inner: int | None = None,
    by: str | None = None,
) -> DataFrame:
    """(key, root): fingerprints (fp, tail) linked within both budgets, named by their hex digits,
    each with a member of its class in some task.

    ``inner``: budget within one of the groups; as it is, no link can be without such a group.
    ``by``: a column of numbers; only fingerprints that are equal in it are joined, in one trie for
    each number, without groups of bits.
    """
    if by is not None:
        return _links_by(distinct.select(F.col(by).alias("bucket"), "fp", "tail"), budget, whole)
    inner = budget // parts if inner is None else inner
    dealt, bounds, levels = _dealt(distinct, parts, inner, levels)

    def run(key: tuple, group: pa.Table) -> pa.Table:
        number = key[0].as_py()
        own, fps, tails = (group.column(name).to_numpy() for name in ("own", "fp", "tail"))
        fps, tails = fps.view(np.uint64), tails.view(np.uint64)
        names = pa.schema([("key", pa.string()), ("root", pa.string())])
        if not own.any() or len(fps) < 2:
            return names.empty_table()
        order = np.lexsort((tails, _rotated(fps, bounds[number])))
        fps, tails = fps[order], tails[order]
        bits = bounds[number + 1] - bounds[number]
        label = trie_links(
            _rotated(fps, bounds[number]), tails, own[order], bits, inner, budget, whole, levels
        )
        return _named(fps, tails, label)

    return dealt.groupBy("trie", "task").applyInArrow(run, "key string, root string")


def _named(fps: np.ndarray, tails: np.ndarray, label: np.ndarray) -> pa.Table:
    """(key, root) of all items that have another label than themselves."""
    linked = np.nonzero(label != np.arange(len(label)))[0]

    def hexes(at: np.ndarray) -> pa.Array:
        pairs = zip(fps[at].tolist(), tails[at].tolist())
        return pa.array([f"{fp:016x}{tail:016x}" for fp, tail in pairs], pa.string())

    return pa.Table.from_arrays([hexes(linked), hexes(label[linked])], ["key", "root"])


def _links_by(keyed: DataFrame, budget: int, whole: int, node: int = NODE) -> DataFrame:
    """``links`` between the fingerprints (bucket, fp, tail) of one bucket.

    A task gets about ``node`` fingerprints: several buckets, each with a trie of its own, which goes
    down at once with the others. A bucket of more is cut into blocks, and every pair of them is one trie.
    """
    keyed = stored(keyed.distinct(), "buckets")
    large = keyed.groupBy("bucket").count().where(F.col("count") > node)
    large = stored(large.withColumn("blocks", F.ceil(F.col("count") / node)), "large")
    more = large.agg(F.sum(F.col("count") * (F.col("blocks") - 1))).first()[0] or 0
    tasks = max(1, -(-(keyed.count() + more) // node))
    blocks = F.coalesce("blocks", F.lit(1).cast("long"))
    placed = keyed.join(large.select("bucket", "blocks"), "bucket", "left").withColumns(
        {"block": F.pmod(F.xxhash64("fp", "tail"), blocks), "other": F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))}
    )
    pair = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    dealt = placed.select("bucket", *pair, "fp", "tail")
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("bucket", "low", "high"), F.lit(tasks)))

    def run(group: pa.Table) -> pa.Table:
        columns = [group.column(name).to_numpy() for name in ("bucket", "low", "high", "fp", "tail")]
        columns[3:] = [column.view(np.uint64) for column in columns[3:]]
        order = np.lexsort(columns[::-1])
        bucket, low, high, fps, tails = (column[order] for column in columns)
        apart = (np.diff(bucket) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)
        edges = np.nonzero(apart)[0] + 1
        lows, highs = np.concatenate([[0], edges]), np.concatenate([edges, [len(fps)]])
        several = highs - lows > 1
        lows, highs = lows[several], highs[several]
        pairs = 0, lows, highs, lows, highs, np.zeros(len(lows), np.int8)
        return _named(fps, tails, _descend(fps, tails, pairs, 0, budget, budget, whole))

    return dealt.groupBy("task").applyInArrow(run, "key string, root string")


def _dealt(
    distinct: DataFrame, parts: int, inner: int, levels: int | None = None
) -> tuple[DataFrame, list[int], int]:
    """Rows of trie, task, fp, tail and own; first bits of the groups; levels above a task's node."""
    bounds = [round(64 * part / parts) for part in range(parts + 1)]
    if levels is None:
        levels = max(4, math.ceil(math.log2(max(1, distinct.count()) / NODE)))
    levels = min(levels, 64 // parts, 20)
    masks = near_prefixes(levels, inner)
    tries = []
    for number in range(parts):
        by = bounds[number]
        turned = F.col("fp") if not by else F.shiftleft("fp", by).bitwiseOR(F.shiftrightunsigned("fp", 64 - by))
        node = F.shiftrightunsigned(turned, 64 - levels).cast("int")
        tries.append(F.struct(F.lit(number).alias("trie"), node.alias("node")))
    homes = distinct.select("fp", "tail", F.inline(F.array(*tries)))
    # To its own node, and to every lower node whose prefix fits: each pair of nodes meets once.
    targets = F.filter(
        F.transform(F.array(*map(F.lit, masks)), lambda mask: F.col("node").bitwiseXOR(mask)),
        lambda target: target <= F.col("node"),
    )
    dealt = homes.withColumn("task", F.explode(targets))
    own = (F.col("task") == F.col("node")).alias("own")
    return dealt.select("trie", "task", "fp", "tail", own), bounds, levels


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, budget: int = BUDGET, parts: int = 2, whole: int | None = None
) -> DataFrame:
    """doc_id, fp, component_id of every row of ``docs`` (doc_id, text).

    ``whole``: budget over 128 bits, where the fingerprint alone would link too much; None: no
    further bits are made.
    """
    found = stored(fingerprints(docs, size, whole is not None), "fingerprints")
    hexes = F.lower(F.concat(F.lpad(F.hex("fp"), 16, "0"), F.lpad(F.hex("tail"), 16, "0")))
    distinct = found.groupBy("fp", "tail").agg(F.min("doc_id").alias("least"))
    distinct = stored(distinct.withColumn("key", hexes), "distinct")
    joined = classes(links(distinct, budget, parts, 128 if whole is None else whole))
    members = joined.unionAll(joined.select(F.col("root").alias("key"), "root").distinct())
    named = members.join(distinct, "key").groupBy("root").agg(F.min("least").alias("component"))
    own = distinct.join(members, "key", "left").join(named, "root", "left")
    own = own.select("fp", "tail", F.coalesce("component", "least").alias("component_id"))
    return found.join(own, ["fp", "tail"]).select("doc_id", "fp", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hex, component_id."""
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


# --- verified classes


def _marked(docs: DataFrame, size: int, row: str, hashed: str, names: list[str]) -> DataFrame:
    """All columns of ``docs``, a row number, the text's hash, and the fingerprint, its further bits,
    a hash and the size of the set of shingles, and the set's buckets."""
    docs = docs.withColumns({row: F.monotonically_increasing_id(), hashed: F.xxhash64("text")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made, buckets = [], []
            for text in as_bytes(batch.column("text")):
                hashes = shingles(text, size)
                own = np.unique(hashes)
                made.append((*_bits(hashes, True), xxhash.xxh64_intdigest(own.tobytes(), SEED), len(own)))
                buckets.append(bands(own))
            more = [pa.array(np.array(column, np.uint64).view(np.int64)) for column in zip(*made)]
            ends = pa.array(np.arange(len(buckets) + 1, dtype=np.int32) * BANDS)
            more.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(buckets).view(np.int64))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *names])

    schema = T.StructType([*docs.schema.fields])
    for name in names[:-1]:
        schema = schema.add(name, "long")
    return docs.mapInArrow(run, schema.add(names[-1], T.ArrayType(T.LongType())))


def _sets_of(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted sets of shingles of the texts, one behind the other, and where they end (0 first)."""
    sets = [np.unique(shingles(text, size)) for text in as_bytes(texts)]
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.cumsum([0, *map(len, sets)])


def _alike(values: np.ndarray, ends: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Labels of sets of shingles (``values`` cut at ``ends``) linked by a Jaccard of 0.8 or more.

    Sets of different sides are compared where there are two sides, else all. What a set shares with
    all others is counted at once, from lists of the sets that hold each of its shingles; sets that
    are in one class already are not told apart again.
    """
    count = len(ends) - 1
    owner, sizes = np.repeat(np.arange(count), np.diff(ends)), np.diff(ends)
    sets, both = _Sets(count), side.min() != side.max()
    order = np.argsort(values, kind="stable")
    held = values[order]
    starts = np.concatenate([[0], np.nonzero(np.diff(held))[0] + 1]) if len(held) else np.zeros(0, np.int64)
    stops = np.append(starts[1:], len(held))
    rank = np.empty(len(held), np.int64)
    rank[order] = np.repeat(np.arange(len(starts)), stops - starts)
    holders = owner[order]
    for own in range(count):
        lists = rank[ends[own] : ends[own + 1]]
        lists = lists[stops[lists] - starts[lists] > 1]
        if not len(lists):
            continue
        found = np.concatenate([holders[a:b] for a, b in zip(starts[lists].tolist(), stops[lists].tolist())])
        common = np.bincount(found, minlength=count)
        # In whole numbers: common / (left + right - common) >= 4 / 5.
        near = (9 * common >= 4 * (sizes + sizes[own])) & (sets.label != sets.label[own])
        if both:
            near &= side != side[own]
        others = np.nonzero(near)[0]
        sets.link(np.full(len(others), own), others)
    return sets.label


def verified(families: DataFrame, texts: DataFrame, size: int, block: int = BLOCK) -> DataFrame:
    """(key, root): links of Jaccard 0.8 or more between members of a family.

    ``families``: (key, root, shingles, row); ``texts``: (row, text). Tasks are sent texts, which take
    less room than their sets of ``size``-word shingles, and make the sets. Small families share tasks. A family of more than ``block`` shingles is cut into blocks, and every
    pair of them is a task; each returns links to the smallest member of its classes only.
    """
    sizes = families.groupBy("root").agg(F.greatest(F.sum("shingles"), F.lit(1)).alias("all"))
    sizes = stored(sizes.withColumn("blocks", F.ceil(F.col("all") / block)), "sizes")
    tasks = sizes.where("blocks = 1").agg(F.coalesce(F.ceil(F.sum("all") / block), F.lit(1))).first()[0]
    place = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("root"), F.lit(tasks)))
    alone = F.when(F.col("blocks") > 1, F.col("root"))
    placed = families.join(sizes, "root").withColumns(
        {"own": F.pmod(F.xxhash64("key"), F.col("blocks")), "place": place, "alone": alone}
    )
    placed = stored(placed.drop("all", "shingles"), "families").join(texts, "row")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = placed.select("key", "root", "own", "text", "place", "alone", other).select(
        "*", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )

    def run(key: tuple, group: pa.Table) -> pa.Table:
        out: list[tuple[str, str]] = []
        group = group.combine_chunks()
        names, roots = group.column("key").to_pylist(), np.array(group.column("root").to_pylist(), object)
        order = np.argsort(roots, kind="stable")
        cuts = np.nonzero(roots[order][1:] != roots[order][:-1])[0] + 1
        texts = group.column("text")
        side = group.column("own").to_numpy()
        for rows in np.split(order, cuts):
            if len(rows) < 2:
                continue
            label = _alike(*_sets_of(texts.take(pa.array(rows)), size), side[rows])
            for at in np.nonzero(label != np.arange(len(label)))[0].tolist():
                out.append((names[rows[at]], names[rows[label[at]]]))
        columns = list(zip(*out)) or [[], []]
        return pa.Table.from_arrays([pa.array(column, pa.string()) for column in columns], ["key", "root"])

    return dealt.groupBy("place", "alone", "low", "high").applyInArrow(run, "key string, root string")


def _with_roots(edges: DataFrame) -> DataFrame:
    """(key, root) of all keys with a link, roots among them."""
    roots = classes(edges)
    return stored(roots.unionAll(roots.select(F.col("root").alias("key"), "root").distinct()), "roots")


def deduplicated(docs: DataFrame, size: int = 5, budget: int = 22, whole: int = 36) -> DataFrame:
    """The row with the smallest doc_id of every class, then by the hash of its text; columns as in ``docs``.

    A class is a connected component of texts whose sets of ``size``-word shingles have a Jaccard of
    0.8 or more. Fingerprints only name the families within which texts are compared: those connected
    by steps within ``whole`` of 128 bits and ``budget`` of the first 64, between texts that share a
    bucket. A resemblance of 0.8 stands for 19 bits (the angle's cosine c gives c / (2 - c)), with an
    error of four.

    Rows that repeat a doc_id count one by one; rows without doc_id are members like others, after
    those with one. Nulls and texts without words are one class; a long text is one set; ties go by
    the hash of the text, then by place; an empty table gives no rows; clashing names stay.
    """
    wanted = "row", "hash", "fp", "tail", "shape", "shingles", "buckets"
    row, hashed, *names = free_names(docs, *wanted)
    marked = stored(_marked(docs, size, row, hashed, names), "marked")
    wanted = zip((row, hashed, *names), wanted)
    slim = marked.select("doc_id", *[F.col(own).alias(name) for own, name in wanted])
    key = F.lower(F.concat(*[F.lpad(F.hex(name), 16, "0") for name in ("fp", "tail", "shape")])).alias("key")
    items = slim.groupBy("fp", "tail", "shape", "shingles").agg(F.min("row").alias("row"))
    items = stored(items.select("*", key), "items")
    pair = F.substring("key", 1, 32)
    keyed = slim.select(F.explode("buckets").alias("bucket"), "fp", "tail")
    near = _with_roots(links(keyed, budget, whole=whole, by="bucket"))
    near = near.select(F.col("key").alias("pair"), "root")
    # Texts of equal fingerprints are a family too, where nothing else is near.
    families = items.select("key", "row", "shingles", pair.alias("pair")).join(near, "pair", "left")
    families = families.select("key", "row", "shingles", F.coalesce("root", "pair").alias("root"))
    several = families.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("root")
    families = families.join(several, "root")
    texts = marked.select(F.col(row).alias("row"), "text")
    linked = _with_roots(stored(verified(families, texts, size), "verified"))
    named = items.select("fp", "tail", "shape", "key").join(linked, "key", "left")
    named = named.select("fp", "tail", "shape", F.coalesce("root", "key").alias("root"))
    found = slim.join(named, ["fp", "tail", "shape"])
    first = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "hash", "row")
    kept = found.groupBy("root").agg(F.min(first).alias("least")).select(F.col("least.row").alias(row))
    columns = [F.col(f"`{column}`") for column in docs.columns]
    return marked.join(kept, row, "left_semi").select(*columns)
