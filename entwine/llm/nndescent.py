"""Approximate nearest neighbours by NN-descent and greedy graph search (operator 8).

Index. Equal vectors are one node. A sample of PIVOTS nodes, or the root of their number if that is more, gives a first graph: every node is compared within the
blocks (about BLOCK nodes) of its SPREAD nearest pivots. Then rounds of NN-descent: the neighbours of each node, in either
direction, are joined to their vectors and compared with each other; a node keeps the DEGREE nearest it has seen. Only
nodes with a new neighbour are joined again, and rounds end when few neighbours change. All nodes are in the graph.
Distances in it are those of the original vectors, kept edges by differences in double precision.

Search. A query starts at its own node and its BEAM nearest pivots. Each hop joins its WIDE nearest nodes that have not been expanded to
their neighbours, either direction, and these to their vectors; the BEAM nearest stay. Hops end when all of a query's
beam is expanded. Where the table has no more nodes than pivots, the search is exact.

Results are vectors, not nodes: copies come in the order of their ids, with the exact distance in double precision.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part; null ids do not either,
nor do vectors of another length than most have; of rows with one id the smallest vector counts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .batches import Stages

PIVOTS, BLOCK, SPREAD = 512, 512, 4
DEGREE, JOINED, REVERSE = 32, 16, 32  # neighbours kept; other direction, in rounds and in search
OFFERS = 4  # candidates that a comparison of neighbours offers to each of them
ROUNDS, CHANGED = 40, 0.02
BEAM, WIDE, HOPS = 256, 64, 40


def matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * a @ b.T, 0)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal keys, for partitions sorted by the key; a run may span batches."""
    held: pa.Table | None = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        k = held.column(key).to_numpy()
        if len(k) and k[0] != k[-1]:
            cut = int(np.searchsorted(k, k[-1]))
            yield held.slice(0, cut)
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held


def centred(x: np.ndarray) -> np.ndarray:
    """By the row of median length: products of close rows keep their digits, and a far row doesn't cost the others theirs."""
    return x - x[np.argpartition((x**2).sum(axis=1), len(x) // 2)[len(x) // 2]]


def compared(key: str, most: int):
    """For rows (key, node, v, radius) sorted by key: each node's `most` nearest of its run, where nearer than its radius.
    -> u, v, d (squared distance)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, key):
            k, node, x, radius = t.column(key).to_numpy(), t.column("node").to_numpy(), matrix(t.column("v")), t.column("radius").to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1], [True]]))
            us, vs, ds = [], [], []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if b - a < 2:
                    continue
                own = x[a:b]
                c = centred(own)
                d = squared(c, c)
                np.fill_diagonal(d, np.inf)
                n = min(most, b - a - 1)
                near = np.argpartition(d, n - 1, axis=1)[:, :n]
                d = np.stack([((own - own[k]) ** 2).sum(axis=1) for k in near.T], axis=1)
                good = d < radius[a:b, None]
                us.append(np.repeat(node[a:b], n)[good.ravel()])
                vs.append(node[a:b][near][good])
                ds.append(d[good])
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (us, vs)] + [pa.array(np.concatenate(ds).astype(np.float64))], ["u", "v", "d"])

    return work


def nearest(edges: DataFrame, group: str, other: str, most: int, *carried: Column) -> DataFrame:
    """The `most` nearest of each group, each once, ties to the smaller id."""
    once = edges.groupBy(group, other).agg(F.min("d").alias("d"), *carried)
    rank = F.row_number().over(Window.partitionBy(group).orderBy("d", other))
    return once.withColumn("r", rank).where(F.col("r") <= most).drop("r")


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the vectors that take part; x keeps single or double precision."""
    x = F.col("x")
    kind = vectors.schema[vector_col].dataType
    exact = "array<float>" if isinstance(getattr(kind, "elementType", None), T.FloatType) else "array<double>"
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    found = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast(exact).alias("x"))
    kept = found.where(F.col("id").isNotNull() & x.isNotNull() & finite & F.exists(x, lambda c: c != 0))
    return kept.groupBy("id").agg(F.min("x").alias("x"))


def of_one_length(rows: DataFrame) -> DataFrame:
    """The rows of the most frequent length, the smallest of equals."""
    size = F.size("x")
    usual = rows.groupBy(size.alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    return rows.where(size == usual[0]["n"]) if usual else rows


def both_ways(graph: DataFrame, most: int) -> DataFrame:
    """(a, b): neighbours of a node, and at most `most` nodes that it is a neighbour of, the nearest."""
    rank = F.row_number().over(Window.partitionBy("v").orderBy("d", "u"))
    back = graph.withColumn("r", rank).where(F.col("r") <= most).select(F.col("v").alias("a"), F.col("u").alias("b"))
    return graph.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(back).distinct()


def first_graph(nodes: DataFrame, pivots: np.ndarray, stages: Stages) -> DataFrame:
    """u, v, d: nearest of each node within blocks of its nearest pivots."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = squared(matrix(b.column("v")), pivots)
            near = np.argsort(d, axis=1, kind="stable")[:, :SPREAD]
            for k in range(near.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(near[:, k].astype(np.int64)), b.column("node")], ["pivot", "node"])

    near = stages.put(nodes.mapInArrow(assign, "pivot long, node long"))
    parts = near.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    block = (F.col("pivot") * F.lit(1 << 32) + F.pmod(F.xxhash64("node"), F.col("parts"))).alias("block")
    placed = near.join(F.broadcast(parts), "pivot").select(block, "node").join(nodes, "node").select("block", "node", "v", F.lit(float("inf")).alias("radius")).repartition("block").sortWithinPartitions("block")
    out = stages.put(nearest(placed.mapInArrow(compared("block", DEGREE), "u long, v long, d double"), "u", "v", DEGREE).withColumn("new", F.lit(1)))
    stages.drop(near)
    return out


def descend(nodes: DataFrame, graph: DataFrame, stages: Stages) -> DataFrame:
    """Rounds of NN-descent over graph (u, v, d, new)."""
    for _ in range(ROUNDS):
        pairs = both_ways(graph, JOINED)
        fresh = graph.where("new = 1").select(F.explode(F.array("u", "v")).alias("a")).distinct()
        lists = pairs.join(fresh, "a", "left_semi")
        # A node with a full list takes only what is nearer than its last neighbour.
        last = graph.groupBy("u").agg(F.when(F.count("*") >= DEGREE, F.max("d")).otherwise(float("inf")).alias("radius"))
        placed = nodes.join(last, F.col("node") == F.col("u"), "left").select("node", "v", F.coalesce("radius", F.lit(float("inf"))).alias("radius"))
        with_vectors = lists.join(placed, lists["b"] == placed["node"]).select("a", "node", "v", "radius")
        offered = with_vectors.repartition("a").sortWithinPartitions("a").mapInArrow(compared("a", OFFERS), "u long, v long, d double")
        both = graph.select("u", "v", "d", F.lit(0).alias("new")).unionByName(offered.withColumn("new", F.lit(1)))
        after = stages.put(nearest(both, "u", "v", DEGREE, F.min("new").alias("new")))
        stages.drop(graph)
        graph = after
        edges, changed = graph.agg(F.count("*"), F.sum("new")).first()
        if not edges or changed < CHANGED * edges:
            break
    return graph


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(q, node, v, qv) -> (q, node, d): sum of squared differences in double precision."""
    for b in batches:
        d = ((matrix(b.column("v")) - matrix(b.column("qv"))) ** 2).sum(axis=1) if b.num_rows else np.zeros(0)
        yield pa.RecordBatch.from_arrays([b.column("q"), b.column("node"), pa.array(d)], ["q", "node", "d"])


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, pivots: np.ndarray, pivot_ids: np.ndarray, stages: Stages) -> DataFrame:
    """queries (q, qv, own) -> q, node, d: the beam of each query."""

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, q = matrix(b.column("qv")), b.column("q").to_numpy()
            d = np.stack([((row - pivots) ** 2).sum(axis=1) for row in x]) if len(x) else np.zeros((0, len(pivots)))
            near = np.argsort(d, axis=1, kind="stable")[:, :BEAM]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(q, near.shape[1])), pa.array(pivot_ids[near].ravel()), pa.array(np.take_along_axis(d, near, axis=1).ravel()), pa.array(np.zeros(near.size, np.int32))], ["q", "node", "d", "expanded"])

    links = stages.put(both_ways(graph, REVERSE))
    entries = queries.mapInArrow(enter, "q long, node long, d double, expanded int")
    own = queries.select("q", F.col("own").alias("node"), F.lit(0.0).alias("d"), F.lit(0).alias("expanded"))
    beam = stages.put(entries.unionByName(own).dropDuplicates(["q", "node"]))
    for _ in range(HOPS):
        order = F.row_number().over(Window.partitionBy("q").orderBy("expanded", "d", "node"))
        ranked = beam.withColumn("r", order)
        front = (F.col("expanded") == 0) & (F.col("r") <= WIDE)
        reached = ranked.where(front).join(links, F.col("node") == links["a"]).select("q", F.col("b").alias("node")).distinct()
        unseen = reached.join(beam.select("q", "node"), ["q", "node"], "left_anti")
        pairs = unseen.join(nodes, "node").join(queries, "q").select("q", "node", "v", "qv")
        found = pairs.mapInArrow(measured, "q long, node long, d double").withColumn("expanded", F.lit(0))
        held = ranked.select("q", "node", "d", F.when(front, 1).otherwise(F.col("expanded")).alias("expanded"))
        after = stages.put(nearest(held.unionByName(found), "q", "node", BEAM, F.max("expanded").alias("expanded")))
        stages.drop(beam)
        beam = after
        if beam.where("expanded = 0").limit(1).count() == 0:
            break
    return beam


def neighbours(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row that `queries` (over a column `id`) picks, by
    Euclidean distance among all other rows."""
    spark = vectors.sparkSession
    stages = Stages(spark, "nndescent")
    rows = of_one_length(stages.put(valid(vectors, id_col, vector_col)))
    nodes = stages.put(rows.groupBy("x").agg(F.min("id").alias("node")).select("node", F.col("x").alias("v")))
    picked = nodes.orderBy(F.xxhash64("node"), "node").limit(max(PIVOTS, math.isqrt(nodes.count()))).collect()
    if not picked:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    pivots, pivot_ids = np.array([r["v"] for r in picked], np.float64), np.array([r["node"] for r in picked])
    graph = descend(nodes, first_graph(nodes, pivots, stages), stages)
    asked = rows.where(queries).select(F.col("id").alias("q"), F.col("x").alias("qv"))
    asked = stages.put(asked.join(nodes, F.col("qv") == F.col("v")).select("q", "qv", F.col("node").alias("own")))
    beam = search(asked, nodes, graph, pivots, pivot_ids, stages)
    # A query needs at most k + 1 copies of a node, itself among them.
    copy = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    copies = rows.withColumn("c", copy).where(F.col("c") <= k + 1).select(F.col("id").alias("vec_id"), F.col("x").alias("v"))
    members = copies.join(nodes, "v").select("node", "vec_id")
    found = beam.join(members, "node").where("vec_id <> q").select("q", "vec_id", F.sqrt("d").alias("score"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy("score", "vec_id")).cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("q").alias("query_id"), "rank", "vec_id", "score")
