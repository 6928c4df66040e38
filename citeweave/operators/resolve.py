"""A resolver for identifiers that no index has: asked once, within one bound, and remembered."""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.scratch import scratch
from citeweave.storage import exists

#: True or a status of 200 to 399: found. False or another status: missing. An OSError, a timeout too: an error.
Resolver = Callable[[str], bool | int]

ANSWERS = "doi string, outcome string, detail string, asked_at timestamp"
#: Statuses that may be others the next time.
PASSING = frozenset({408, 425, 429, 500, 502, 503, 504})


class _Stay(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *args, **kwargs):
        return None


@cache
def _opener() -> urllib.request.OpenerDirector:
    """One a process: it cannot be sent to tasks."""
    return urllib.request.build_opener(_Stay)


def head_status(timeout: float = 5.0, base: str = "https://doi.org/") -> Resolver:
    """The status of a HEAD request without following redirects."""

    def resolve(doi: str) -> int:
        request = urllib.request.Request(base + urllib.parse.quote(doi, safe="/:;()"), method="HEAD")
        try:
            with _opener().open(request, timeout=timeout) as answer:
                return answer.status
        except urllib.error.HTTPError as e:
            return e.code

    return resolve


def head_resolver(timeout: float = 5.0, base: str = "https://doi.org/") -> Resolver:
    """2xx and 3xx resolve; other statuses, errors and timeouts do not."""
    status = head_status(timeout, base)

    def resolve(doi: str) -> bool:
        try:
            return 200 <= status(doi) < 400
        except OSError:
            return False

    return resolve


def outcome(resolver: Resolver, doi: str, retries: int = 0, pause: float = 0.5) -> tuple[str, str]:
    """found, missing or error, and what was said. Passing statuses and errors are asked again, after ever longer pauses."""
    for attempt in range(retries + 1):
        if attempt:
            time.sleep(pause * 2 ** (attempt - 1))
        try:
            said = resolver(doi)
        except OSError as e:  # any other exception is a fault of the resolver, and ends the job
            last = "error", f"{type(e).__name__}: {e}"[:200]
            continue
        if isinstance(said, bool):
            return ("found" if said else "missing"), ""
        if said not in PASSING:
            return ("found" if 200 <= said < 400 else "missing"), str(said)
        last = "error", str(said)
    return last


def ask(unknown: DataFrame, resolver: Resolver, concurrency: int = 50, partitions: int = 8, retries: int = 0, pause: float = 0.5) -> DataFrame:
    """unknown: distinct doi. At most concurrency requests are in flight, over all tasks together."""
    tasks = max(1, min(partitions, concurrency))
    workers = max(1, concurrency // tasks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(workers) as pool:
            for batch in batches:
                said = list(pool.map(lambda doi: outcome(resolver, doi, retries, pause), batch["doi"]))
                yield pd.DataFrame({"doi": batch["doi"], "outcome": [o for o, _ in said], "detail": [d for _, d in said], "asked_at": pd.Timestamp.now("UTC").tz_localize(None)})

    return unknown.repartition(tasks).mapInPandas(run, ANSWERS)


def resolve_unmatched(
    looked_up: DataFrame,
    resolver: Resolver,
    source: str,
    concurrency: int = 50,
    partitions: int = 8,
    column: str = "doi",
    table: str | None = None,
    retries: int = 0,
) -> DataFrame:
    """Asks the resolver for each distinct unmatched identifier that table has no answer for.

    What resolves gets matched_source = source (all counts as datacite). table is a folder to which answers are added
    before they are used: another run asks only for what is new, and for what ended in an error. Without one, answers
    live as long as this run's scratch folder.
    """
    spark = looked_up.sparkSession
    label = "datacite" if source in ("all", "arxiv") else source
    kept = f"{scratch(spark)}/looked_up"  # written first: it is read twice, and what it rests on may be long
    looked_up.write.parquet(kept)
    looked_up = spark.read.schema(looked_up.schema).parquet(kept)
    table = table or f"{scratch(spark)}/answers"
    unknown = looked_up.where(F.col("matched_source").isNull()).select(F.col(column).alias("doi")).where(F.col("doi").isNotNull()).distinct()
    if exists(spark, table):
        settled = spark.read.schema(ANSWERS).parquet(table).where("outcome <> 'error'").select("doi").distinct()
        unknown = unknown.join(settled, "doi", "left_anti")
    ask(unknown, resolver, concurrency, partitions, retries).write.mode("append").parquet(table)
    found = spark.read.schema(ANSWERS).parquet(table).where("outcome = 'found'").select(F.col("doi").alias("r_doi")).distinct()
    joined = looked_up.join(found, looked_up[column] == F.col("r_doi"), "left")
    missing = F.col("matched_source").isNull() & F.col("r_doi").isNotNull()
    return joined.withColumn("matched_source", F.when(missing, F.lit(label)).otherwise(F.col("matched_source"))).drop("r_doi")
