"""Stage manifest for resumable runs, and incremental extraction of newly arrived references."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citeweave.functions.keys import partition_key
from citeweave.operators.extract import extract_edges
from citeweave.schemas import REFS
from citeweave.storage import exists, names

PHASES = ("extract", "invert", "validate", "complete")


@dataclass
class Manifest:
    """Which phases of a run are done, what they counted, and which run it is; kept as JSON next to its outputs.

    Key ranges are in the run's commit log; the lists here are for runs of a few partitions.
    """

    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    phase: str = "extract"
    partitions_written: list[str] = field(default_factory=list)
    partitions_inverted: list[str] = field(default_factory=list)
    stats: dict[str, int] = field(default_factory=dict)
    #: Digests of the options and of the input's files.
    options: str = ""
    input: str = ""

    def mark(self, what: str, key: str) -> None:
        done = getattr(self, what)
        seen = self.__dict__.setdefault("_seen", {}).setdefault(what, set())
        if len(seen) != len(done):
            seen.update(done)
        if key not in seen:
            seen.add(key)
            done.append(key)

    def is_inverted(self, key: str) -> bool:
        return key in self.partitions_inverted

    def advance(self, phase: str) -> None:
        if PHASES.index(phase) < PHASES.index(self.phase):
            raise ValueError(f"a run does not go back from {self.phase} to {phase}")
        self.phase = phase

    def save(self, spark: SparkSession, path: str) -> None:
        """Writes a new folder beside the last one, in whatever store; the one of the highest number holds."""
        n = max(_saved(spark, path), default=0) + 1
        spark.createDataFrame([(json.dumps(asdict(self), indent=2),)], "value string").coalesce(1).write.option("lineSep", "\0").text(f"{path}/{n:08d}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Manifest | None:
        found = _saved(spark, path)
        if not found:
            return None
        text = spark.read.text(f"{path}/{max(found):08d}", wholetext=True).where(F.trim("value") != "").first()[0]
        return cls(**json.loads(text.rstrip("\0")))


def _saved(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the saves that were finished."""
    return [int(name) for name in names(spark, path) if exists(spark, f"{path}/{name}/_SUCCESS")]


def pending_edges(edges: DataFrame, manifest: Manifest) -> DataFrame:
    """Edges of the partition keys that a run has not inverted yet."""
    done = edges.sparkSession.createDataFrame([(k,) for k in manifest.partitions_inverted], "done string")
    return edges.join(done, partition_key(F.col("cited_id")) == F.col("done"), "left_anti")


def stream_edges(spark: SparkSession, source: str, sink: str, checkpoint: str, mode: str = "doi") -> StreamingQuery:
    """Extracts edges of Parquet reference files as they arrive; each file is processed once."""
    refs: DataFrame = spark.readStream.schema(REFS).parquet(source)
    return extract_edges(refs, mode).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
