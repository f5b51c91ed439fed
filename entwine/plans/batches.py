"""A run in batches of S1 records that can be stopped and taken up again.

Each batch writes its two lists, then one manifest file, which is renamed into place: a batch without a readable manifest
never happened. On the next start its half-written lists are deleted and it runs anew; committed batches are skipped.
Settings, number of batches included, are part of each manifest; a run with others is refused.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features
from ..operators.prepare import prepare
from ..sources.records import CANDIDATES, MATCHES, pad, spine_lists, write_lists
from ..streaming.incremental import fingerprint
from .pipeline import Pipeline

KINDS = {"matches": MATCHES, "candidates": CANDIDATES}


class Store:
    """A folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def at(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def names(self, folder: str) -> list[str]:
        fs, path = self.at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def delete(self, name: str) -> None:
        fs, path = self.at(name)
        fs.delete(path, True)

    def read(self, name: str) -> str:
        fs, path = self.at(name)
        stream = fs.open(path)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8", "replace")
        finally:
            stream.close()

    def commit(self, name: str, text: str) -> None:
        """Writes a file beside its place, then renames it."""
        fs, path = self.at(name)
        _, beside = self.at(f"{name}.tmp")
        stream = fs.create(beside, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        fs.delete(path, False)
        if not fs.rename(beside, path):
            raise OSError(f"no rename to {path}")


class BatchRun:
    def __init__(self, pipeline: Pipeline, out: str, batches: int):
        self.pipeline, self.batches = pipeline, batches
        self.store = Store(pipeline.spark, out)
        self.settings = f"{fingerprint(pipeline)}-{batches}"

    def committed(self) -> dict[int, dict]:
        """Manifest of each finished batch. Unreadable ones count as absent; other settings raise."""
        found = {}
        for name in self.store.names("manifest"):
            if not name.endswith(".json"):
                continue
            try:
                entry = json.loads(self.store.read(f"manifest/{name}"))
                number, settings = int(entry["batch"]), entry["settings"]
            except (ValueError, KeyError, TypeError, Py4JJavaError):  # cut off, or its checksum is wrong
                continue
            if settings != self.settings:
                raise ValueError("the output was begun with other settings")
            found[number] = entry
        return found

    def roll_back(self) -> list[int]:
        """Deletes the lists of batches that were not committed; their numbers."""
        done = self.committed()
        half = {int(n.removeprefix("batch=")) for k in KINDS for n in self.store.names(k) if n.startswith("batch=")} - set(done)
        for number in half:
            for k in KINDS:
                self.store.delete(f"{k}/batch={number}")
        return sorted(half)

    def run(self, records: DataFrame, stop_after: int | None = None) -> dict[int, dict]:
        """records: entity_id, business_name, business_address, country. stop_after: so many new batches, then stop."""
        self.roll_back()
        done, new = self.committed(), 0
        ready = prepare(records, self.pipeline.config.ascii_words, self.pipeline.config.nulls)
        targets, s1 = ready.where("source <> 'S1'"), ready.where("source = 'S1'")
        for number in range(self.batches):
            if number in done:
                continue
            if new == stop_after:
                break
            part = s1.where(F.pmod(F.xxhash64("entity_id"), F.lit(self.batches)) == number)
            pairs = self.pipeline._kept(self.pipeline.candidates(part, targets), f"pairs-{number}")
            scored = self.pipeline.scorer(features.features(pairs, part, targets))
            hits = scored.where(F.col("prob") >= self.pipeline.config.threshold)
            for kind, found in (("matches", hits), ("candidates", pairs)):
                write_lists(spine_lists(part, found, KINDS[kind][1]), f"{self.store.root}/{kind}/batch={number}")
            n = pairs.agg(F.count("*").alias("pairs"), F.count_distinct("s1_id").alias("with_candidates"), F.sum(F.col("cand_id").startswith("S2-").cast("long")).alias("s2")).first().asDict()
            pairs.unpersist()
            done[number] = {"batch": number, "settings": self.settings} | {k: v or 0 for k, v in n.items()}
            self.store.commit(f"manifest/batch={number}.json", json.dumps(done[number]))
            new += 1
        return done

    def lists(self, kind: str) -> DataFrame:
        """The lists of the committed batches."""
        spark, columns = self.pipeline.spark, KINDS[kind]
        paths = [f"{self.store.root}/{kind}/batch={n}" for n in sorted(self.committed())]
        schema = ", ".join(f"{c} string" for c in columns)
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).options(sep="\t", header=True, quote="").csv(paths).na.fill("")

    def snapshot(self, s1: DataFrame, out: str) -> None:
        """Both lists so far, with an empty one for every S1 record that is still to come."""
        for kind in KINDS:
            write_lists(pad(self.lists(kind), s1), f"{out}/{kind}")
