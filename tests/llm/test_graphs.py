"""Vectors, the manifest and the trie against plain versions, and their registered queries against SQL."""

from __future__ import annotations

import hashlib
import math
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartloom.checks.compare import compare, connect
from cartloom.llm import cap_filters, components, merkle, prefix_trie
from cartloom.llm.queries import ORACLE, QUERIES
from cartloom.llm.ranks import ranked
from cartloom.llm.shared import work_folder

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def ordered(rows):
    return sorted((tuple(row) for row in rows), key=lambda row: tuple(map(str, row)))


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- positions and components


def test_positions_in_a_hot_group(spark):
    rows = [(None if n % 3 == 0 else f"g{n % 7}", n % 50) for n in range(900)]
    found = ranked(spark.createDataFrame(rows, "g string, v long").repartition(6), ["g"], ["v"])
    groups: dict = {}
    for g, v, rank, total in found.collect():
        groups.setdefault(g, []).append((rank, v, total))
    for g, held in groups.items():
        held.sort()
        assert [rank for rank, *_ in held] == list(range(len(held)))
        assert [v for _, v, _ in held] == sorted(v for key, v in rows if key == g)
        assert {total for *_, total in held} == {len(held)}


def test_components_of_a_star_and_a_chain(spark):
    edges = [(n, 0) for n in range(1, 400)] + [(n, n + 1) for n in range(1000, 1060)] + [(5, 5)]
    found = components.components(spark.createDataFrame(edges, "key long, root long"))
    assert dict(found.collect()) == {n: 0 for n in range(1, 400)} | {n: 1000 for n in range(1001, 1061)}


def test_no_links_no_components(spark):
    assert components.components(spark.createDataFrame([], "key long, root long")).collect() == []


# --- spherical caps


def plain_links(rows, cosine=cap_filters.COSINE):
    size = len(rows)
    label, links = list(range(size)), [0] * size
    units = []
    for _, vector in rows:
        values = np.array([math.nan if v is None else v for v in vector or []], float)
        good = len(values) and np.isfinite(values).all() and values.any()
        values = values / np.abs(values).max() if good else values
        units.append(values / np.linalg.norm(values) if good else None)
    for a in range(size):
        for b in range(a):
            if units[a] is None or units[b] is None or len(units[a]) != len(units[b]) or units[a] @ units[b] < cosine:
                continue
            links[a] += 1
            links[b] += 1
            old, new = label[a], label[b]
            label = [new if value == old else value for value in label]
    least: dict = {}
    for (key, _), name in zip(rows, label):
        if key is not None:
            least[name] = min(least.get(name, key), key)
    return ordered((key, links[n], least.get(label[n]), key == least.get(label[n])) for n, (key, _) in enumerate(rows))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_odd_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [0.0] * 4), (4, [1.0, None, 0.0, 0.0]), (5, [math.nan, 1.0, 0.0, 0.0]),
        (6, [1.0, 0.0, 0.0, 0.0]), (7, [2.0, 0.0, 0.0, 0.0]), (7, [2.0, 0.0, 0.0, 0.0]), (8, [1.0, 0.0, 0.0]),
        (None, [3.0, 0.0, 0.0, 0.1]), (None, [0.0, 1.0, 0.0, 0.0]), (9, [1e300, 0.0, 0.0, 0.0]),
        (10, [math.inf, 0.0, 0.0, 0.0]),
    ]
    found = cap_filters.report(vectors(spark, rows).withColumns({"FILTERS": F.lit("x"), "row": F.lit(1), "Unit": F.lit(2)}))
    assert ordered(found.collect()) == plain_links(rows)


def test_no_vectors(spark):
    assert cap_filters.report(vectors(spark, [])).collect() == []


def test_hot_group_open_pairs_and_recall(spark):
    """Near copies of one vector, groups wider than a cluster, pairs at the bound, and strangers."""
    rng = np.random.default_rng(5)
    rows = []

    def add(vector):
        rows.append((len(rows), vector.tolist()))

    hot = rng.normal(size=24)
    for _ in range(250):
        add(hot + rng.normal(size=24) * 0.02 * np.linalg.norm(hot))
    for _ in range(8):
        centre = rng.normal(size=24)
        for _ in range(30):
            add(centre + rng.normal(size=24) * rng.choice([0.03, 0.05, 0.07]) * np.linalg.norm(centre))
    for _ in range(200):
        x = rng.normal(size=24)
        x /= np.linalg.norm(x)
        z = rng.normal(size=24)
        z -= (z @ x) * x
        z /= np.linalg.norm(z)
        cosine = rng.uniform(0.94, 0.96)
        add(x)
        add(cosine * x + math.sqrt(1 - cosine * cosine) * z)
    found, wanted = ordered(cap_filters.report(vectors(spark, rows)).collect()), plain_links(rows)
    got, all_links = sum(row[1] for row in found), sum(row[1] for row in wanted)
    assert all(mine[1] <= theirs[1] for mine, theirs in zip(found, wanted))
    assert got >= 0.99 * all_links
    assert [row for row in found if row[0] < 250] == [row for row in wanted if row[0] < 250]


def test_a_dense_group_makes_no_pairs(spark):
    rng = np.random.default_rng(6)
    rows = [(n, (np.ones(16) + rng.normal(size=16) * 0.01).tolist()) for n in range(300)]
    found = cap_filters.decoded(vectors(spark, rows))
    angle = math.acos(cap_filters.COSINE)
    members = cap_filters.clusters(found, angle)
    assert members.select("centre").distinct().count() < 10
    assert cap_filters.meetings(found, members, angle).count() < 50


def test_filters_are_the_best_products():
    code = cap_filters.Code(6, 2000, 0)
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(5, 6))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    sizes = [len(directions) for directions in code.directions]
    scores = np.zeros((5, 1))
    for start, end, directions in zip(code.cuts, code.cuts[1:], code.directions):
        block = (unit @ code.turn)[:, start:end] @ directions.T
        scores = (scores[:, :, None] + block[:, None, :]).reshape(5, -1)
    assert scores.shape[1] == math.prod(sizes)
    best = np.sort(np.argsort(-scores, axis=1)[:, : code.keep], axis=1)
    assert np.array_equal(best, np.sort(code.decode(unit), axis=1))


# --- Merkle manifest


def plain_manifest(rows):
    def leaf(row, low=False):
        doc_id, text, lang, source, n_chars = row
        if low and text is not None:
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        fields = (doc_id, source, lang, n_chars, text)
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])

    def tree(level):
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for n, place in enumerate(at):
                run = level[place // 16 * 16 : place // 16 * 16 + 16]
                paths[n].append(("".join(run[: place % 16]), "".join(run[place % 16 + 1 :])))
                at[n] = place // 16
            level = [digest(*level[start : start + 16]) for start in range(0, len(level), 16)]
        return level[0], paths

    by_source: dict = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(((row[0] is not None, row[0] or 0, leaf(row)), row))
    order = sorted(by_source, key=lambda source: (source is not None, (source or "").encode()))
    trees = {}
    for source in order:
        by_source[source].sort(key=lambda held: held[0])
        trees[source] = tree([held[0][2] for held in by_source[source]])
    if not order:
        return []
    root, tops = tree([trees[source][0] for source in order])
    out = []
    for n, source in enumerate(order):
        for own, ((*_, at_rest), row) in zip(trees[source][1], by_source[source]):
            path = own + tops[n]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            node = leaf(row, True) if hit else at_rest
            for before, after in path:
                node = digest(before, node, after)
            out.append((row[0], at_rest, trees[source][0], root, digest(*map("".join, path)), node, node == root))
    return ordered(out)


def test_manifest(docs, rows):
    assert ordered(merkle.report(docs).collect()) == plain_manifest(rows)


def test_manifest_of_repeated_and_hot_rows(repeated):
    assert ordered(merkle.report(repeated).collect()) == plain_manifest([tuple(row) for row in repeated.collect()])


@pytest.mark.parametrize("sources", [1, 300, 37])
def test_manifest_over_several_heights(spark, sources):
    rows = [(n, f"Text {n % 250}", "en", f"s{n % sources}" if n % sources else None, 9) for n in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert ordered(merkle.report(frame.repartition(5)).collect()) == plain_manifest(rows)


def test_manifest_of_clashing_and_empty_tables(clashing, rows, empty):
    assert ordered(merkle.report(clashing).collect()) == plain_manifest(rows)
    assert merkle.report(empty).collect() == []


def test_single_requests(spark):
    rows = [(n, f"Text {n}", "en", "ab"[n % 2], 7) for n in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stored = ranked(merkle.leaves(frame), ["source"], ["doc_id", "leaf"])
    trees = merkle.manifest(stored.select("source", "rank", "total", F.col("leaf").alias("digest")), "source")
    asked = stored.where("doc_id in (0, 7, 899)").unionAll(stored.where("doc_id = 7"))
    found = merkle.proofs(*trees, asked).select("doc_id", "root", merkle.fold(F.col("leaf"), F.col("path")).alias("folded"))
    assert sorted(row.doc_id for row in found.collect()) == [0, 7, 7, 899]
    assert all(row.root == row.folded for row in found.collect())
    foreign = merkle.proofs(*trees, asked.withColumn("rank", F.col("rank") + 1))
    folded = foreign.select("root", merkle.fold(F.col("leaf"), F.col("path")).alias("folded"))
    assert not any(row.root == row.folded for row in folded.collect())


# --- prefix trie


def plain_trie(rows):
    own: dict = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, digest(f"{len(role.encode())}:", role, text))
            own.setdefault(conv, []).append((order, (role, text)))
    own = {conv: [turn for _, turn in sorted(held)] for conv, held in own.items()}
    new = {}
    for conv, held in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - int(math.fmod(conv, 5))
        new[conv] = own.get(base, [])[:h] + held[h:]
    members: dict = {}
    for conv, held in new.items():
        for depth in range(len(held) + 1):
            members.setdefault(tuple(held[:depth]), []).append(conv)
    children: dict = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    figures: dict = {}
    for node in sorted(members, key=len, reverse=True):
        below = [figures[child] for child in children.get(node, [])]
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        figures[node] = sum(leaves for leaves, _ in below) or 1, saved + sum(other for _, other in below)
    out = []
    for node, held in members.items():
        ends = ",".join(str(conv) for conv in sorted(held) if len(new[conv]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), len(children.get(node, [])), *figures[node], digest(ends)))
    return ordered(out)


TURNS = [
    (conv, turn, None if turn == 3 else "user" if turn % 2 else "bot", None if turn == 4 else f"é text {conv % 6 // (1 + turn % 3)}")
    for conv in (*range(-4, 40), 60, 61)
    for turn in range(conv % 13)
]
TURNS += [(3, None, "bot", "first"), (3, 1, "bot", "same turn"), (3, 1, "bot", "same turn"), (None, 0, "bot", "nobody's")]
TURN_SCHEMA = "conv_id long, turn long, role string, text string"


def trie_rows(frame, **settings):
    return ordered(prefix_trie.trie(frame, **settings).collect())


@pytest.mark.parametrize("width, shards", [(16, None), (2, 7), (1, 3), (5, 40)])
def test_trie(spark, width, shards):
    frame = spark.createDataFrame(TURNS, TURN_SCHEMA).repartition(4)
    assert trie_rows(frame, width=width, shards=shards) == plain_trie(TURNS)


def test_trie_of_a_hot_conversation(spark):
    """Most conversations are copies, so nodes and their ends go over many shards; one conversation is very long."""
    rows = [(5 * conv, turn, "user", f"turn {turn}") for conv in range(300) for turn in range(11)]
    rows += [(2001, turn, "user", "y" * (turn % 4)) for turn in range(120)]
    frame = spark.createDataFrame(rows, TURN_SCHEMA)
    assert trie_rows(frame, width=4, shards=9) == plain_trie(rows)


def test_trie_of_clashing_and_empty_tables(spark):
    frame = spark.createDataFrame(TURNS, TURN_SCHEMA).withColumns({"ID": F.lit("x"), "bytes": F.lit(1), "at": F.lit(0)})
    assert trie_rows(frame) == plain_trie(TURNS)
    assert trie_rows(spark.createDataFrame([], TURN_SCHEMA)) == []
    one = [(4, 0, "user", "x" * 200_000)]
    assert trie_rows(spark.createDataFrame(one, TURN_SCHEMA)) == plain_trie(one)


# --- registered queries


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
@pytest.mark.parametrize("name", ["op11_cap_filters", "op12_merkle_descent", "op13_prefix_trie"])
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name]) is None


def test_sql_on_awkward_rows(spark, rows):
    """The SQL and the operators on nulls, ties and copies."""
    folder = f"{work_folder(spark)}/awkward"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet", mode="overwrite"
    )
    spark.createDataFrame(TURNS, TURN_SCHEMA).write.parquet(f"{folder}/conversations.parquet", mode="overwrite")
    held = [(n, [1.0, 0.1 * (n // 4), 0.0]) for n in range(30)] + [(40, None), (41, [0.0, 0.0, 0.0]), (None, [1.0, 0.0, 0.0])]
    vectors(spark, held).write.parquet(f"{folder}/embeddings.parquet", mode="overwrite")
    import duckdb

    connection = duckdb.connect()
    for name in ("documents", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    for name in ("op11_cap_filters", "op12_merkle_descent", "op13_prefix_trie"):
        assert compare(QUERIES[name](spark, folder), connection, ORACLE[name]) is None, name
