"""Merkle manifest of a dataset: a stored DAG of digests, and proofs by descent from its root.

Every document is a leaf. Within a source the leaves stand in the order of their numbers, and every
16 neighbours become one node until one is left; the sources' last nodes are joined to the root in
the same way. Of every node only (digest, children) is stored, one table per height: content
addresses, so equal nodes are one record.

A request names a source and a rank. All requests descend together: the records on the paths from
the root to the requested ranks are opened height by height, the digit of the rank chooses the child
that is followed, and the children that are not chosen are collected as a segment (left and right of
it) of the path. Every node is opened once, however many requests pass it, so the root is no hot key.
The last digit is each request's own. The segments, reversed, are the proof.

Defined results: a null field counts as ``-``; empty and very long texts are hashed whole; a null source
is a source of its own, the first; rows without doc_id come first in their source; rows that share
a doc_id stand by their digest, and equal rows are leaves of their own; columns besides the five are
not read, so clashing names do no harm; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cartloom.llm.ranks import matched, ranked
from cartloom.llm.shared import stored

WIDTH = 16
DIGEST = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before:string,after:string>>"


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Digest of a document's fields, each with its length in bytes."""
    parts = []
    for name in FIELDS:
        value = fields[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, and altered: the leaf after tampering, null where there is none."""
    fields = {name: F.col(name) for name in FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    changed = leaf_digest(fields | {"text": F.translate("text", _UPPER, _LOWER)})
    return docs.select("doc_id", "source", leaf_digest(fields).alias("leaf"), F.when(hit, changed).alias("altered"))


@dataclass
class Dag:
    """Records (digest, children) of a forest by height from 1, and its tops (group columns, total, digest)."""

    group: list[str]
    records: list[DataFrame]
    tops: DataFrame


def build(nodes: DataFrame, group: list[str]) -> Dag:
    """The forest over nodes (group columns, rank, total, digest), one tree per group."""
    row = nodes.agg(F.max("total")).first()
    most = (row and row[0]) or 0
    pairs = F.transform(F.array_sort(F.collect_list(F.struct("rank", "digest"))), lambda node: node["digest"])
    single = [*group, "total", "digest"]
    tops, records = nodes.where("total = 1").select(*single, F.lit(0).alias("height")), []
    level = nodes.select(*group, "rank", F.col("total").alias("wide"), "total", "digest")
    while most > 1:
        run = F.floor(F.col("rank") / WIDTH).cast("long").alias("rank")
        level = level.where("wide > 1").groupBy(*group, "total", "wide", run).agg(F.array_join(pairs, "").alias("children"))
        level = level.withColumns({"digest": F.sha2("children", 256), "wide": F.ceil(F.col("wide") / WIDTH).cast("long")})
        level = stored(level, "nodes")
        records.append(stored(level.select("digest", "children").dropDuplicates(["digest"]), "records"))
        tops = tops.unionAll(level.where("wide = 1").select(*single, F.lit(len(records)).alias("height")))
        most = -(-most // WIDTH)
    return Dag(group, records, stored(tops, "tops"))


def _segment(children: Column, digit: Column) -> Column:
    """The children left and right of a digit's."""
    at = digit * DIGEST
    return F.struct(
        F.substring(children, F.lit(1), at).alias("before"),
        F.substring(children, at + DIGEST + 1, F.length(children)).alias("after"),
    )


def _child(children: Column, digit: Column) -> Column:
    return F.substring(children, digit * DIGEST + 1, F.lit(DIGEST))


def _opened(paths: DataFrame, records: DataFrame) -> DataFrame:
    """The paths' nodes, with their children."""
    return paths.join(records.withColumnRenamed("digest", "digest_of"), F.col("digest") == F.col("digest_of")).drop(
        "digest_of"
    )


def descend(dag: Dag, starts: DataFrame, wanted: DataFrame, *more: str) -> DataFrame:
    """(group columns, run, path, ``more``, children) of every run of leaves with a wanted one.

    ``starts``: group columns, digest, height, path and ``more`` of the tops; ``wanted``: group columns,
    run (rank // 16), each once. A top that is a leaf has run 0 and no children.
    """
    asked = [wanted]
    for _ in range(1, len(dag.records)):
        up = asked[-1].select(*dag.group, F.floor(F.col("run") / WIDTH).cast("long").alias("run")).distinct()
        asked.append(stored(up, "wanted"))
    columns = [*dag.group, "run", "path", *more]
    starts = starts.withColumn("run", F.lit(0).cast("long"))
    lone = starts.where("height = 0").select(*columns, F.lit(None).cast("string").alias("children"))
    if not dag.records:
        return lone
    nodes = None
    for high in range(len(dag.records), 0, -1):
        here = starts.where(F.col("height") == high).select(*columns, "digest")
        here = here if nodes is None else here.unionAll(nodes)
        here = matched(here, asked[high - 1], [*dag.group, "run"], "left_semi")
        here = stored(_opened(here, dag.records[high - 1]), "opened")
        digits = F.sequence(F.lit(0), (F.length("children") / DIGEST).cast("int") - 1)
        split = here.select(*columns, "children", F.explode(digits).alias("digit"))
        nodes = split.select(
            *dag.group,
            (F.col("run") * WIDTH + F.col("digit")).alias("run"),
            F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"),
            *more,
            _child(F.col("children"), F.col("digit")).alias("digest"),
        )
    return here.select(*columns, "children").unionAll(lone)


def manifest(nodes: DataFrame, group: str) -> tuple[Dag, Dag]:
    """The trees of the groups of nodes (group, rank, total, digest), and the tree over their tops."""
    trees = build(nodes, [group])
    tops = ranked(trees.tops.withColumnRenamed("total", "leaves"), [], [group])
    tops = stored(tops.withColumnRenamed("digest", "subroot"), "subroots")
    over = build(tops.select(F.col("subroot").alias("digest"), "rank", "total"), [])
    trees.tops = tops
    return trees, over


def proofs(trees: Dag, over: Dag, requests: DataFrame) -> DataFrame:
    """All columns of the requests (the group column, rank, ...) with subroot, root and path.

    ``path``: segments from the leaf's run up to the root. Requests of unknown leaves have no row.
    """
    [group] = trees.group
    runs = requests.select(group, F.floor(F.col("rank") / WIDTH).cast("long").alias("run"))
    wanted = stored(runs.distinct(), "wanted")
    subroots = matched(trees.tops, wanted, [group], "left_semi")
    empty = F.array().cast(_PATH)
    above = subroots.select(F.floor(F.col("rank") / WIDTH).cast("long").alias("run")).distinct()
    top = descend(over, over.tops.select("digest", "height", empty.alias("path")), stored(above, "wanted"))
    digit = F.pmod("rank", F.lit(WIDTH)).cast("int")
    last = F.when(F.col("children").isNotNull(), F.array(_segment(F.col("children"), digit)))
    whole = F.concat("path", F.coalesce(last, empty)).alias("path")
    tops = subroots.withColumn("run", F.floor(F.col("rank") / WIDTH).cast("long")).join(top, "run")
    starts = stored(tops.select(group, F.col("subroot").alias("digest"), "subroot", "height", whole), "starts")
    bottom = descend(trees, starts, wanted, "subroot").withColumnRenamed(group, "group_of")
    asked = requests.withColumn("own_run", F.floor(F.col("rank") / WIDTH).cast("long"))
    found = asked.join(bottom, F.col(group).eqNullSafe(F.col("group_of")) & (F.col("own_run") == F.col("run")))
    path = F.reverse(F.concat("path", F.coalesce(last, empty)))
    root = over.tops.first()
    return found.select(
        *requests.columns, "subroot", F.lit(root and root["digest"]).alias("root"), path.alias("path")
    )


def siblings(path: Column) -> Column:
    """Digest of the siblings of a path, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def report(docs: DataFrame) -> DataFrame:
    """Every document's leaf, subroot, root and proof, and whether it still gives the root after tampering."""
    requests = stored(ranked(leaves(docs), ["source"], ["doc_id", "leaf"]), "leaves")
    nodes = requests.select("source", "rank", "total", F.col("leaf").alias("digest"))
    found = proofs(*manifest(nodes, "source"), requests)
    folded = fold(F.coalesce("altered", "leaf"), F.col("path"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", siblings(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
