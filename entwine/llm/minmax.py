"""Near-duplicates by min-max hashing (operator 3).

1. One pass over the texts: the set of word shingles of each, a fingerprint of the set, and the minimum and the maximum
   of the set under PERMUTATIONS permutations, each evaluated once for both. Texts with equal sets are one class.
2. Two permutations (two minima, two maxima) make a band. A pair of similarity 0.8 shares none of BANDS bands with a
   probability of 4e-7. Bands are grouped to buckets. In each, the text of the smallest id leads: every other is compared
   with it exactly, by whole shingle sets, in parts of BLOCK texts. Components of these links are clusters.
3. Buckets that hold texts of several clusters may hide further links. In buckets of at most BUCKET texts, texts of
   different clusters are linked for candidates where the estimate of the whole signature is at least SIEVE (0.8 less 5
   standard errors); larger ones link all their clusters. Candidate groups of clusters are compared exactly: the texts
   outside a group's largest cluster with all of the group, in tiles of two blocks of BLOCK texts. Sets whose sizes differ
   by too much for the similarity are in blocks that don't meet, and texts of one cluster are not compared again.
4. Components of all links.

Copies are never expanded to pairs, no link is lost but by step 2's probability, and no group is capped. A group of near
copies around one text costs a comparison each; what is quadratic is the part of a candidate group outside its largest
cluster.

Defined results: null text, and text without words, has no shingles and is linked with nothing; a text of fewer words
than the width has one shingle, its whole sequence; a row with a null id takes no part (component and kept are null);
repeated rows have the same component; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import Stages, bitmap, bounded_batches, passes, slices, slot_of, utf8
from .components import components
from .shingles import min_max, mixed, shingle_sets

PERMUTATIONS, BANDS = 56, 28
SIEVE = 0.6
BUCKET, BLOCK = 512, 256
TEXT_SLICE = 1 << 18  # bytes of text; hashing takes some hundred bytes for each


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """docs (id, text) -> id, n_shingles, f1, f2 (fingerprint of the set), bands, coarse (one byte of each value)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=TEXT_SLICE):
            values, offsets = shingle_sets(*utf8(b.column("text")), width)
            n = np.diff(offsets)
            full = np.flatnonzero(n)
            bands, coarse = [None] * len(n), [None] * len(n)
            f1, f2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(full):
                edges = np.append(offsets[:-1][full], len(values))
                low, high = min_max(values, edges, PERMUTATIONS)
                f1[full] = np.add.reduceat(mixed(values), edges[:-1])
                f2[full] = np.add.reduceat(mixed(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), edges[:-1])
                keys = np.empty((BANDS, len(full)), np.uint64)
                for k in range(BANDS):
                    key = np.full(len(full), k + 1, np.uint64)
                    for part in (low[2 * k], high[2 * k], low[2 * k + 1], high[2 * k + 1]):
                        key = mixed(key + part)
                    keys[k] = key
                short = np.concatenate([low, high]).T.astype(np.uint8)
                for i, key, c in zip(full.tolist(), signed(np.ascontiguousarray(keys.T)), short, strict=True):
                    bands[i], coarse[i] = key, c.tobytes()
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(n), pa.array(signed(f1)), pa.array(signed(f2)), pa.array(bands, pa.list_(pa.int64())), pa.array(coarse, pa.binary())], ["id", "n_shingles", "f1", "f2", "bands", "coarse"])

    return docs.mapInArrow(run, "id long, n_shingles long, f1 long, f2 long, bands array<long>, coarse binary")


def by_group(work: Callable[[list[dict]], pa.RecordBatch], key: str, heavy: str) -> Callable:
    """Runs `work` on the rows of each key, for partitions that are sorted by the key; a group may span batches.
    heavy: the column with most of the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in slices(batches, heavy):
            for row in b.to_pylist():
                if held and held[0][key] != row[key]:
                    yield work(held)
                    held = []
                held.append(row)
        if held:
            yield work(held)

    return run


def edge_batch(a: np.ndarray | list[int], b: np.ndarray | list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def spanning(label: np.ndarray, links: Iterator[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """(label, smallest label of its group) of all labels that are linked with another. links: a place, and the places
    linked to it."""
    now = label.copy()
    for i, to in links:
        if len(to):
            found = np.unique(np.append(now[to], now[i]))
            if len(found) > 1:
                now[np.isin(now, found)] = found[0]
    moved = np.flatnonzero(now != label)
    pairs = np.unique(np.stack([label[moved], now[moved]], axis=1), axis=0) if len(moved) else np.zeros((0, 2), np.int64)
    return edge_batch(pairs[:, 0], pairs[:, 1])


def likely(rows: list[dict]) -> pa.RecordBatch:
    """Spanning links between the clusters of one bucket, by texts whose signatures agree in at least SIEVE of their values."""
    label = np.array([r["root"] for r in rows], np.int64)
    coarse = np.frombuffer(b"".join(r["coarse"] for r in rows), np.uint8).reshape(len(rows), -1)
    links = ((i, np.flatnonzero((label[i + 1 :] != label[i]) & ((coarse[i + 1 :] == coarse[i]).mean(axis=1) >= SIEVE)) + i + 1) for i in range(len(rows) - 1))
    return spanning(label, links)


def shingle_rows(docs: DataFrame, wanted: bytes, width: int) -> DataFrame:
    """docs (id, text, slot) -> (id, shingles) of the texts that pass the sieve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=TEXT_SLICE):
            b = b.filter(pa.array(passes(b.column("slot").to_numpy(), wanted)))
            values, offsets = shingle_sets(*utf8(b.column("text")), width)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([values[x:y].tobytes() for x, y in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())], ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles binary")


def alike(sets: list[np.ndarray], probes: list[int], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each probe (a place, in order) the later places with 100 * intersection >= percent * union."""
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    places = np.unique(flat, return_inverse=True)[1]
    begins = np.cumsum(n) - n
    marked = np.zeros(len(flat), bool)
    for i in probes:
        if i + 1 < len(sets):
            mine = places[begins[i] : begins[i] + n[i]]
            marked[mine] = True
            both = np.add.reduceat(marked[places[begins[i + 1] :]].astype(np.int64), begins[i + 1 :] - begins[i + 1])
            marked[mine] = False
            yield i, np.flatnonzero(100 * both >= percent * (n[i] + n[i + 1 :] - both)) + i + 1


def distinct(rows: list[dict], *keys: str) -> list[dict]:
    """The first row of each id (rows of one id and several texts count once), in the order of keys."""
    return list({r["id"]: r for r in sorted(rows, key=lambda r: tuple(r[k] for k in (*keys, "id", "shingles")), reverse=True)}.values())[::-1]


def with_leader(percent: int) -> Callable[[list[dict]], pa.RecordBatch]:
    """Links of the texts of one tile with its leader, the row of part 0."""

    def work(rows: list[dict]) -> pa.RecordBatch:
        rows = distinct(rows, "part")
        if rows[0]["part"] != 0:
            return edge_batch([], [])
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        found = [to for _, to in alike(sets, [0], percent)]
        return edge_batch([rows[i]["id"] for to in found for i in to.tolist()], [rows[0]["id"]] * sum(map(len, found)))

    return work


def across(percent: int) -> Callable[[list[dict]], pa.RecordBatch]:
    """Spanning links between clusters of one tile: rows of part 0 with each other, if part 1 is empty, and with part 1."""

    def work(rows: list[dict]) -> pa.RecordBatch:
        rows = distinct(rows, "part")
        label, part = np.array([r["root"] for r in rows], np.int64), np.array([r["part"] for r in rows])
        sets, firsts = [np.frombuffer(r["shingles"], np.uint64) for r in rows], int((part == 0).sum())
        own = firsts == len(rows)
        links = ((i, to[(label[to] != label[i]) & (own | (to >= firsts))]) for i, to in alike(sets, list(range(firsts)), percent))
        return spanning(label, links)

    return work


def leader_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): true links of the members (band, id, center) with their centers."""
    pairs = members.where("id <> center").select("id", "center").distinct()
    sizes = pairs.groupBy("center").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    placed = pairs.join(sizes, "center").select("id", "center", F.xxhash64("center", F.pmod(F.xxhash64("id"), F.col("parts"))).alias("tile"))
    leaders = placed.select(F.col("center").alias("id"), "tile").distinct().withColumn("part", F.lit(0))
    held = placed.select("id", "tile").withColumn("part", F.lit(1)).unionByName(leaders).join(sets, "id")
    return held.repartition("tile").sortWithinPartitions("tile").mapInArrow(by_group(with_leader(percent), "tile", "shingles"), "a long, b long")


def candidates(members: DataFrame, reps: DataFrame, clusters: DataFrame, stages: Stages) -> DataFrame:
    """(a, b): links of clusters (node, root) that some bucket makes likely."""
    rooted = members.join(clusters, F.col("id") == F.col("node"), "left").select("band", "id", "m", F.coalesce("root", "id").alias("root"))
    mixed = rooted.groupBy("band").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("band", "least")
    open_ = stages.put(rooted.join(mixed, "band"))
    star = open_.where(f"m > {BUCKET} and root <> least").select(F.col("root").alias("a"), F.col("least").alias("b")).distinct()
    small = open_.where(f"m <= {BUCKET}").select("band", "id", "root").join(reps.select("id", "coarse"), "id")
    linked = small.repartition("band").sortWithinPartitions("band").mapInArrow(by_group(likely, "band", "coarse"), "a long, b long")
    return star.unionByName(linked).distinct()


def tiles(nodes: DataFrame, percent: int, stages: Stages) -> DataFrame:
    """nodes (id, root, grp, n) -> (tile, part, id, root): all pairs of texts of a group that are not both in its largest
    cluster, and whose sizes are near enough, meet in a tile."""
    sizes = nodes.groupBy("grp", "root").agg(F.count("*").alias("c"))
    main = sizes.groupBy("grp").agg(F.max(F.struct(F.col("c"), (-F.col("root")).alias("r"))).alias("x")).select("grp", (-F.col("x.r")).alias("main"))
    step = F.lit(math.log(100 / percent) * 1.0001) if percent < 100 else F.lit(1e-9)
    level = F.floor(F.log(F.col("n").cast("double")) / step).cast("long")
    sided = nodes.join(main, "grp").select("id", "root", "grp", (F.col("root") == F.col("main")).cast("int").alias("side"), level.alias("level"))
    counts = sided.groupBy("grp", "side", "level").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("parts"))
    placed = stages.put(sided.join(counts, ["grp", "side", "level"]).select("id", "root", "grp", "side", "level", F.pmod(F.xxhash64("id"), F.col("parts")).alias("b")))
    blocks = counts.select("grp", "side", "level", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("b"))
    x, y = (blocks.select("grp", *(F.col(c).alias(f"{c}{k}") for c in ("side", "level", "b"))) for k in (1, 2))
    one, two = F.struct("side1", "level1", "b1"), F.struct("side2", "level2", "b2")
    meet = x.where("side1 = 0").join(y, "grp").where((F.abs(F.col("level1") - F.col("level2")) <= 1) & ((F.col("side2") == 1) | (one <= two)))
    named = stages.put(meet.withColumn("tile", F.xxhash64("grp", "side1", "level1", "b1", "side2", "level2", "b2")))
    first = named.select("grp", F.col("side1").alias("side"), F.col("level1").alias("level"), F.col("b1").alias("b"), "tile", F.lit(0).alias("part"))
    second = named.where(one != two).select("grp", F.col("side2").alias("side"), F.col("level2").alias("level"), F.col("b2").alias("b"), "tile", F.lit(1).alias("part"))
    return first.unionByName(second).join(placed, ["grp", "side", "level", "b"]).select("tile", "part", "id", "root")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, n_shingles, component_id (smallest id reachable over links), kept (id = component_id)."""
    spark = docs.sparkSession
    stages = Stages(spark, "minmax")
    texts = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    signed_docs = stages.put(signatures(texts, width))
    known = signed_docs.where("n_shingles > 0 and id is not null")
    reps = stages.put(known.groupBy("f1", "f2", "n_shingles").agg(F.min(F.struct("id", "bands", "coarse")).alias("r")).select("f1", "f2", "n_shingles", "r.*"))
    banded = reps.select("id", F.explode("bands").alias("band"))
    buckets = stages.put(banded.groupBy("band").agg(F.count("*").alias("m"), F.min("id").alias("center")).where("m > 1"))
    members = stages.put(banded.join(buckets, "band"))
    sets = stages.put(shingle_rows(texts.where("id is not null").withColumn("slot", slot_of("id")), bitmap(members, slot_of("id")), width))
    clusters = stages.put(components(leader_links(members, sets, percent), stages))
    near = stages.put(candidates(members, reps, clusters, stages))
    if near.isEmpty():
        found = clusters
    else:
        groups = components(near, stages).select(F.col("node").alias("root"), F.col("root").alias("grp"))
        every = reps.select("id", F.col("n_shingles").alias("n")).join(clusters, F.col("id") == F.col("node"), "left").select("id", "n", F.coalesce("root", "id").alias("root"))
        nodes = stages.put(every.join(groups, "root").select("id", "root", "grp", "n"))
        held = tiles(nodes, percent, stages).join(sets, "id").repartition("tile").sortWithinPartitions("tile")
        more = components(held.mapInArrow(by_group(across(percent), "tile", "shingles"), "a long, b long"), stages)
        last = more.select(F.col("node").alias("root"), F.col("root").alias("_last"))
        joined = clusters.join(last, "root", "left").select("node", F.coalesce("_last", "root").alias("root"))
        # Clusters of one text have no row yet.
        found = stages.put(joined.unionByName(last.select(F.col("root").alias("node"), F.col("_last").alias("root")).join(clusters.select("node"), "node", "left_anti")))
    classes = stages.put(reps.select("f1", "f2", "n_shingles", "id").join(found, F.col("id") == F.col("node"), "left").select("f1", "f2", "n_shingles", F.coalesce("root", "id").alias("component")))
    for old in (reps, buckets, members, sets, clusters, near, found):
        stages.drop(old)
    out = signed_docs.select("id", "n_shingles", "f1", "f2").join(classes, ["f1", "f2", "n_shingles"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), (F.col("id") == component).alias("kept"))
