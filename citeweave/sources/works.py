"""Work records: tar.gz archives of JSON members, and directories of extracted JSON, from any store that Spark reads."""

from __future__ import annotations

import io
import json
import re
import tarfile
from collections.abc import Iterator
from itertools import accumulate, chain, groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.schemas import REFERENCE, SCAN

# Reference keys that are read, in the order of the schema.
FIELDS = ("DOI", "URL", "article-title", "journal-title", "unstructured", "doi-asserted-by")
NAMES = [f.split()[0] for f in REFERENCE[len("struct<") : -1].split(", ")]

#: File names that are broadcast at most (about 50 MB); beyond, the contents of files are shuffled.
BROADCAST_NAMES = 500_000
#: A larger member is rejected unread, so that a task holds one of this size at most.
MAX_MEMBER = 1 << 30
#: Items that a task passes on at once.
ITEMS = 256


#: Made once: json.dumps makes an encoder a call when it is told how to write.
_as_json = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode
_quoted = json.encoder.encode_basestring


def _reference(ref: object) -> tuple[str | None, ...]:
    """The fields of the schema, and the reference itself as JSON with sorted keys."""
    if not isinstance(ref, dict):
        return (*[None] * len(FIELDS), _as_json(ref))
    values = [*map(ref.get, FIELDS)]
    if set(map(type, ref.values())) <= {str}:  # most are: as the encoder writes them, which is slow to set up
        return (*values, "{" + ",".join([f"{_quoted(k)}:{_quoted(ref[k])}" for k in sorted(ref)]) + "}")
    return (*[v if isinstance(v, str) else None for v in values], _as_json(ref))


def parse_items(raw: bytes) -> Iterator[tuple[int, str | None, list[tuple[str | None, ...]]]]:
    """(position, DOI, references) of every item of one JSON document; a reference has the values of NAMES. ValueError when it is malformed."""
    doc = json.loads(raw)
    items = doc.get("items") if isinstance(doc, dict) else None
    for k, item in enumerate(items if isinstance(items, list) else []):
        item = item if isinstance(item, dict) else {}
        doi, refs = item.get("DOI"), item.get("reference")
        yield k, doi if isinstance(doi, str) else None, [_reference(r) for r in (refs if isinstance(refs, list) else [])]


def _member(path: str, ordinal: int, read) -> Iterator[dict]:
    """The items of a member, and one row without item_ord that says what became of it."""
    row = {"entry_path": path, "entry_ord": ordinal, "item_ord": None, "doi": None, "refs": None, "status": "read"}
    try:
        raw = read()
        if isinstance(raw, str):
            row["status"] = raw
        else:
            for k, doi, refs in parse_items(raw):
                yield {**row, "item_ord": k, "doi": doi, "refs": refs, "status": None}
    except (ValueError, RecursionError) as e:
        row["status"] = f"malformed: {e}"[:200]
    yield row


_ITEM = pa.schema([
    ("entry_path", pa.string()), ("entry_ord", pa.int64()), ("item_ord", pa.int32()), ("doi", pa.string()),
    ("refs", pa.list_(pa.struct([(n, pa.string()) for n in NAMES]))), ("status", pa.string()),
])


_REF = _ITEM.field("refs").type.value_type


def _batch(rows: list[dict]) -> pa.RecordBatch:
    """Column by column: references, the most by far, are no dicts on the way."""
    refs = [r["refs"] for r in rows]
    # A null offset stands for a null list; the last one is the end.
    ends = list(accumulate((len(r or ()) for r in refs), initial=0))
    offsets = pa.array([None if r is None else a for r, a in zip(refs, ends)] + ends[-1:], pa.int32())
    flat = [ref for r in refs if r for ref in r]
    columns = zip(*flat) if flat else [()] * len(NAMES)
    structs = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in columns], fields=list(_REF))
    others = {name: pa.array([r[name] for r in rows], _ITEM.field(name).type) for name in _ITEM.names if name != "refs"}
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, structs) if n == "refs" else others[n] for n in _ITEM.names], schema=_ITEM)


def _dealt(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, ITEMS)):
        yield _batch(held)


class _Lines(io.RawIOBase):
    """The bytes of a file that comes as its lines."""

    def __init__(self, lines: Iterator[bytes]):
        self.lines, self.left = lines, b""

    def read(self, size: int = -1) -> bytes:
        parts, have = [self.left], len(self.left)
        while have < size and (line := next(self.lines, None)) is not None:
            parts += [line, b"\n"]
            have += len(line) + 1
        held = b"".join(parts)
        out, self.left = held[:size], held[size:]
        return out


def _archive_members(path: str, ordinal: int, lines: Iterator[bytes], largest: int) -> Iterator[dict]:
    with tarfile.open(fileobj=_Lines(lines), mode="r|") as archive:
        for n, member in enumerate(archive):
            if member.isfile() and member.name.endswith(".json"):
                size = member.size
                read = (lambda m=member: archive.extractfile(m).read()) if size <= largest else (lambda s=size: f"too large: {s} bytes")
                yield from _member(f"{path}!{member.name}", (ordinal << 40) + n, read)


def _plain(uri: str) -> str:
    """Spark writes file:/a and file:///a."""
    return re.sub("^([^:/]+):/+", r"\1:/", uri)


def scan_archives(spark: SparkSession, path: str, largest: int = MAX_MEMBER) -> DataFrame:
    """Items of tar.gz archives, and beside them one row for each *.json member: read, or why it was rejected.

    path: archives, a folder of them or a glob, in whatever store Spark reads: the gzip stream comes as the lines of
    Spark's own reader, so no file is opened in Python, and is cut into members on the way. Such a stream cannot be
    split: an archive is one task. The order is that of paths, then of members. A broken archive fails the job.
    """
    files = spark.read.option("lineSep", "\n").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").text(path)
    ordinals = {_plain(name): k for k, name in enumerate(sorted(files.inputFiles()))}  # a name an archive

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The lines of a file stand together, in their order.
        lines = chain.from_iterable(zip(b.column("file").to_pylist(), b.column("value").cast(pa.binary()).to_pylist()) for b in batches)
        for name, own in groupby(lines, lambda x: x[0]):
            stream = (line for _, line in own)
            yield from _dealt(_archive_members(name, ordinals[_plain(name)], stream, largest))
            for _ in stream:  # what may follow the archive's end
                pass

    return files.select(F.col("_metadata.file_path").alias("file"), "value").mapInArrow(run, SCAN)


def scan_directory(spark: SparkSession, path: str, largest: int = MAX_MEMBER) -> DataFrame:
    """The same of a directory of extracted *.json members; the order is that of file names.

    Spark does not list empty files, so these have no row.
    """
    files = spark.read.option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").format("binaryFile").load(path)
    names = files.select("path").orderBy("path")
    # Ordinals of files: rank by name, from the small list of names alone.
    ranked = names.rdd.zipWithIndex().map(lambda x: (x[0][0], x[1])).toDF("path string, entry_ord bigint")
    if names.count() <= BROADCAST_NAMES:  # so that contents are not shuffled; beyond, a sort-merge join
        ranked = F.broadcast(ranked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                name, content, ordinal = (batch.column(c)[k] for c in ("path", "content", "entry_ord"))
                yield from _dealt(_member(name.as_py(), ordinal.as_py(), lambda c=content: c.as_py() or b""))

    small = files.where(F.col("length") <= largest).select("path", "content").join(ranked, "path").mapInArrow(run, SCAN)
    large = files.where(F.col("length") > largest).select("path", "length").join(ranked, "path")
    status = F.concat(F.lit("too large: "), F.col("length").cast("string"), F.lit(" bytes"))
    rejected = large.select(F.col("path").alias("entry_path"), "entry_ord", status.alias("status"))
    return small.unionByName(rejected, allowMissingColumns=True)


def items(scanned: DataFrame) -> DataFrame:
    return scanned.where("item_ord IS NOT NULL").drop("status")


def members(scanned: DataFrame) -> DataFrame:
    """(entry_path, entry_ord, status): read, or the reason why a member was rejected."""
    return scanned.where("item_ord IS NULL").select("entry_path", "entry_ord", "status")


def read_archive(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Works of archives, dealt out right after the scan as each archive is read by one task."""
    works = items(scan_archives(spark, path))
    return works.repartition(partitions) if partitions else works.hint("rebalance")


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    return items(scan_directory(spark, path))


def works_index(works: DataFrame) -> DataFrame:
    return works.where(F.col("doi").isNotNull()).select(F.lower("doi").alias("doi")).distinct()
