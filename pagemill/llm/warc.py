"""Deterministic sharded WARC writer, and a reader of its archives.

Records are range-sorted by id, so a shard holds a stretch of ids. Where a range
ends is planned from a histogram of payload bytes over the ids, not from a random
sample: cells heavier than ``range_bytes`` are split and counted again until none is,
however the ids are spread, and a single id (or null) that is heavier is split by
digest. Inside a range a shard is rolled when its compressed size reaches
``shard_bytes``: the same rows give the same files, byte for byte. Headers, record
ids and digests are made anew from the payload. The driver holds four numbers for each
``range_bytes`` of payload at most (about 200 MB for 100 TB).

Of records with equal payloads of at least ``least_bytes`` bytes the one with
the smallest id is a response, the others revisit it.

Commit: a task writes a shard under a temporary name that holds its attempt and
moves it to its final name when it is complete; a task that runs again, or twice,
moves the same bytes to the same name. The manifest (one row per shard: name, records,
bytes, SHA-256) is written by Spark's own committer after all shards, and
readers take only shards that it names, so what a lost executor leaves behind
is never read.

Cases: a null html is an empty payload; a null id comes before the others and is written
without the id header; a null url is written without a target; rows repeated
with the same id and payload are one response and revisits of it (or all responses, if
short). An empty table gives an empty manifest and no shard. Other columns are
not read. A payload is held whole in one task, shards and ranges are not. Archives are
read back by one task a shard (``MAX_TASKS`` tasks at most, dealt evenly).
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import counted_marked, cut_lineage, text_or_empty

SHARD_BYTES = 8 << 20
RANGE_BYTES = 64 << 20
LEAST_BYTES = 100
#: Cells of the first histogram, and the fewest of a later one.
CELLS = 1 << 12
MAX_TASKS = 20_000
DATE = "2000-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
MANIFEST = "shard string, records long, bytes long, sha256 string, first_id long, last_id long"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
          "shard string")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool) -> bytes:
    """One uncompressed record."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (b"" if revisit else payload)
    lines = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id, digest)),
             ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
             ("Content-Length", str(len(block))), ("WARC-Payload-Digest", f"sha256:{digest}"),
             ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}")]
    if url is not None:
        lines.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if page_id is not None:
        lines.append(("X-Page-ID", str(page_id)))
    if revisit:
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                  ("WARC-Refers-To", _record_id(refers_to, digest))]
        if refers_to is not None:
            lines.append(("X-Refers-To-Page-ID", str(refers_to)))
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    """One gzip member with a fixed header: no time, no name."""
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _file_system(folder: str) -> tuple:
    """File system and path of a folder given as a URI (``file:/...`` as Spark writes it, too)."""
    from pyarrow.fs import FileSystem

    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return FileSystem.from_uri(folder)


def _name(part: int, roll: int) -> str:
    return f"pages-{part:09d}-{roll:05d}.warc.gz"


class _Shard:
    """A shard being written under a temporary name."""

    def __init__(self, folder: str, name: str) -> None:
        self.fs, root = _file_system(folder)
        self.name, self.final = name, f"{root}/{name}"
        self.temporary = f"{root}/.{name}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temporary)
        self.records = self.bytes = 0
        self.sha, self.ids = hashlib.sha256(), []

    def add(self, page_id: int | None, member: bytes) -> None:
        self.out.write(member)
        self.sha.update(member)
        self.records, self.bytes = self.records + 1, self.bytes + len(member)
        self.ids = [*self.ids[:1], page_id]

    def commit(self) -> tuple:
        self.out.close()
        self.fs.move(self.temporary, self.final)
        return self.name, self.records, self.bytes, self.sha.hexdigest(), self.ids[0], self.ids[-1]


class _Ranges:
    """The plan: ``starts`` are the first ids of the ranges after the first, which holds the null ids alone;
    range k is cut into ``subs[k]`` parts by digest, of which the first is number ``base[k]``."""

    def __init__(self, sizes: list[tuple[int, int]], null_bytes: int, range_bytes: int) -> None:
        starts, subs, held = [], [max(1, -(-null_bytes // range_bytes))], 0
        for first, size in sizes:
            if not starts or held + size > range_bytes:
                starts.append(first)
                subs.append(max(1, -(-size // range_bytes)))
                held = 0
            held += size
        self.starts, self.subs = np.array(starts, "int64"), np.array(subs, "int64")
        self.base = np.concatenate([[0], np.cumsum(self.subs)[:-1]]).astype("int64")
        self.parts = int(self.subs.sum())

    def part(self, page_id: Column, digest: Column) -> Column:
        starts, subs, base = self.starts, self.subs, self.base

        def run(ids: pd.Series, absent: pd.Series, prefix: pd.Series) -> pd.Series:
            k = np.where(absent, 0, np.searchsorted(starts, ids.to_numpy("int64"), side="right"))
            return pd.Series(base[k] + (prefix.to_numpy("int64") * subs[k] >> 16))

        return F.pandas_udf(run, "long")(F.coalesce(page_id, F.lit(0)), page_id.isNull(),
                                         F.conv(F.substring(digest, 1, 4), 16, 10).cast("long"))


def _ranges(narrow: DataFrame, range_bytes: int, cells: int = CELLS) -> _Ranges:
    """Plan from histograms of bytes over the ids, each finer where the last one was too heavy."""
    span = narrow.agg(F.min("page_id").alias("low"), F.max("page_id").alias("high"), F.sum(F.when(
        F.col("page_id").isNull(), F.col("payload_bytes"))).alias("null"), F.sum("payload_bytes").alias("all")).first()
    sizes: list[tuple[int, int]] = []
    heavy = [] if span["low"] is None else [(span["low"], span["high"] + 1)]
    most = max(cells, 4 * (span["all"] or 0) // range_bytes)
    while heavy:
        edges = []  # first id of each cell, and the end of the last one of each heavy stretch
        for low, high in heavy:
            width = max(1, -(-(high - low) // max(2, most // len(heavy))))
            edges.extend((at, min(at + width, high)) for at in range(low, high, width))
        firsts, ends = (np.array(e, "object") for e in zip(*edges))
        counted = _cell_sizes(narrow, firsts.astype("int64"), np.array([e - 1 for e in ends], "int64"))
        heavy = []
        for cell, size in counted:
            low, high = edges[cell]
            if size > range_bytes and high - low > 1:
                heavy.append((low, high))
            else:
                sizes.append((low, size))
    return _Ranges(sorted(sizes), span["null"] or 0, range_bytes)


def _cell_sizes(narrow: DataFrame, firsts: np.ndarray, lasts: np.ndarray) -> list[tuple[int, int]]:
    """(cell, bytes) of the cells that hold rows."""
    def run(ids: pd.Series) -> pd.Series:
        of = ids.to_numpy("int64")
        k = np.searchsorted(firsts, of, side="right") - 1
        return pd.Series(np.where((k >= 0) & (of <= lasts[np.maximum(k, 0)]), k, -1))

    cell = F.pandas_udf(run, "long")("page_id")
    rows = narrow.where("page_id is not null").select(cell.alias("cell"), "payload_bytes").where("cell >= 0")
    return [(r["cell"], r["size"]) for r in rows.groupBy("cell").agg(F.sum("payload_bytes").alias("size")).collect()]


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          shard_bytes: int = SHARD_BYTES, range_bytes: int = RANGE_BYTES, least_bytes: int = LEAST_BYTES) -> None:
    """Write the archives and their manifest below ``folder`` (a URI that all executors share)."""
    fs, root = _file_system(folder)
    fs.create_dir(root, recursive=True)
    html = text_or_empty(pages[html_col])
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].alias("url"), html.alias("html"))
    rows = rows.withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256),
                             "payload_bytes": F.octet_length("html").cast("long")})
    narrow = cut_lineage(rows.select("page_id", "digest", "payload_bytes"))
    # payloads that occur more than once: partial aggregation, whatever the size of a group
    repeated = cut_lineage(narrow.where(F.col("payload_bytes") >= least_bytes).groupBy("digest")
                           .agg(F.count(F.lit(1)).alias("copies"), F.min("page_id").alias("first_id")).where("copies > 1")
                           .select("digest", "first_id"))
    marked = counted_marked(rows, repeated, "digest", "may_repeat")
    single = marked.where("not may_repeat").withColumn("first_id", F.lit(None).cast("long")).withColumn("shared", F.lit(False))
    copies = (marked.where("may_repeat").join(repeated.withColumn("shared", F.lit(True)), "digest", "left")
              .withColumn("shared", F.coalesce("shared", F.lit(False))))
    both = single.unionByName(copies).drop("may_repeat")
    plan = _ranges(narrow, range_bytes)
    sort = ["part", "page_id", "digest", "url"]
    columns = [*sort, "html", "shared", "first_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, shard, at, roll, last = [], None, None, 0, None
        for batch in batches:
            for k in range(batch.num_rows):
                p, page_id, digest, url, page, shared, first_id = (batch.column(c)[k].as_py() for c in range(7))
                if p != at:
                    at, roll = p, 0
                    if shard:
                        done.append(shard.commit())
                        shard = None
                if shard is None:
                    shard = _Shard(folder, _name(p, roll))
                # the smallest id responds; of rows that repeat it, the first in this order
                revisit = shared and ((page_id, digest) == last or page_id != first_id)
                last = (page_id, digest)
                shard.add(page_id, _member(record(page_id, url, page.encode(), digest,
                                                  first_id if revisit else None, revisit)))
                if shard.bytes >= shard_bytes:
                    done.append(shard.commit())
                    shard, roll = None, roll + 1
        if shard:
            done.append(shard.commit())
        if done:
            names = [f.strip().split()[0] for f in MANIFEST.split(",")]
            yield pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(names, zip(*done), strict=True)}, schema=pa.schema(
                [(n, pa.string() if n in ("shard", "sha256") else pa.int64()) for n in names]))

    # a part stays in one task, a task takes a stretch of parts, and parts are dealt by their number
    tasks = min(plan.parts, MAX_TASKS)
    sorted_rows = (both.withColumn("part", plan.part(F.col("page_id"), F.col("digest"))).select(*columns)
                   .repartitionById(tasks, F.expr(f"cast(part * {tasks}L div {plan.parts}L as int)"))
                   .sortWithinPartitions(*sort))
    sorted_rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a stream of gzip members."""
    data, unpack, plain = stream.read(1 << 20), zlib.decompressobj(31), []
    while data:
        plain.append(unpack.decompress(data))
        if unpack.eof:
            data, unpack = unpack.unused_data or stream.read(1 << 20), zlib.decompressobj(31)
            whole, plain = b"".join(plain), []
            head, _, rest = whole.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            headers = dict(x.split(": ", 1) for x in lines[1:])
            size = int(headers["Content-Length"])
            if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
                raise ValueError(f"not a whole record: {lines[0]}")
            yield headers, rest[:size]
        else:
            data = stream.read(1 << 20)
    if plain and any(plain):
        raise ValueError("the archive ends inside a record")


def read(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Records of the shards that the manifest names, with digests checked. ``with_payload`` adds
    the payload (null for revisits)."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    fields = RECORD + (", payload binary" if with_payload else "")
    schema = spark.createDataFrame([], fields).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out, strict=True)],
                                              schema=out)

        for batch in batches:
            for shard in batch.column(0).to_pylist():
                fs, root = _file_system(folder)
                held, size = [], 0
                with fs.open_input_stream(f"{root}/{shard}", compression=None) as stream:
                    for headers, block in _records(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        length = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                        if hashlib.sha256(block).hexdigest() != headers["WARC-Block-Digest"].removeprefix("sha256:") or (
                                kind == "response" and (len(payload) != length
                                                        or hashlib.sha256(payload).hexdigest() != digest)):
                            raise ValueError(f"{shard}: digest mismatch in {headers['WARC-Record-ID']}")
                        page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
                        row = (int(page) if page else None, headers.get("WARC-Target-URI"), length, digest, kind,
                               int(refers) if refers else None, shard)
                        held.append((*row, payload if kind == "response" else None) if with_payload else row)
                        size += len(payload) if with_payload else 0
                        if len(held) >= 4096 or size > 8 << 20:
                            yield batch_of(held)
                            held, size = [], 0
                if held:
                    yield batch_of(held)

    # parts first, then the second shards of all parts: about one shard a task
    made = manifest.agg(F.count(F.lit(1)).alias("n"), F.max(F.substring("shard", 7, 9).cast("long")).alias("last")).first()
    tasks = max(1, min(made["n"], MAX_TASKS))
    at = F.substring("shard", 7, 9).cast("long") + F.substring("shard", 17, 5).cast("long") * ((made["last"] or 0) + 1)
    shards = manifest.select("shard").repartitionById(tasks, (at % tasks).cast("int"))
    return shards.mapInArrow(run, schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder that the cluster shares."""
    from pagemill.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
