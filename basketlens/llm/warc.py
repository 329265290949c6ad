"""Deterministic sharded WARC archives.

Records are dealt to shards by ranges of their id and written in the order of ids;
a shard rolls to a new file when the compressed size reaches a limit. Headers and
digests are made anew from the record itself, record ids and dates included, so
that the same pages give the same bytes, however often and wherever a task runs.
Of pages with equal payloads of ``REVISIT_BYTES`` bytes or more, the one with the
largest id is a response, and the others are revisits which refer to it.

Files are written under temporary names that no two attempts share. Each task
passes on a manifest of its files, and Spark keeps the manifest of one attempt of
every task. A second pass renames the files in it to their final names, which can be
repeated safely, and the manifest of final names comes last: readers go by it, so
files of lost attempts and of a commit that broke off are never read.

Ranges are cut so that shards hold about as many bytes each; a row finds its range
by bisection, so the cost follows the rows and only the logarithm of the shards.

Paths may be local or name any file system that ``pyarrow.fs`` opens (``file``,
``hdfs``, ``viewfs``, ``s3``, ``gs``, ``abfs``); ``s3a`` and ``s3n`` are taken as ``s3``, ``dbfs:`` as
the folder where it is mounted. Other schemes are an error before any work starts.

Defined cases: a null payload is empty, a very long one a record of its own length;
a null url gives no target header; repeated rows each give a record, of which, where
long enough, one is the response (the others refer to its id, which is their own);
pages with null ids come first, and a response among them is only chosen where all
equal payloads have null ids: the others are then revisits that name no page.
Records of one id go by digest, then by url. An empty table gives an archive without
files. Columns but the id, the url and the html are not read.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.sources.landing import land, new_path

REVISIT_BYTES = 1000
#: Compressed bytes at which a file is closed, and pages that a shard should hold.
FILE_BYTES = 64 << 20
SHARD_ROWS = 8192
#: Payload bytes that count as much as a row when shards are cut: a shard holds 64 MB at most, but for its last page.
ROW_BYTES = 8192
MAX_SHARDS = 65_536

# What the archive states of its making.
WARC_DATE = "2000-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
MANIFEST = "file string, shard int, number int, records bigint, bytes bigint, sha256 string"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "dbfs":
        return fs.LocalFileSystem(), "/dbfs/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        path = f"s3:{rest}"
    elif scheme == "file":
        path = "file:///" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path)


# --- records ---------------------------------------------------------------


def _block(head: list[tuple[str, str]], first: str) -> bytes:
    return "\r\n".join([first, *(f"{k}: {v}" for k, v in head), "", ""]).encode()


def record_id(page_id, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}/{copy}')}>"


def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record(
    page_id, url: str | None, payload: bytes, refers_to=None, copy: int = 0, revisit: bool | None = None
) -> bytes:
    """A response, or a revisit: headers anew, payload as it is.

    It is a revisit if ``refers_to`` is given, or ``revisit`` says so of a page without id.
    """
    digest = hashlib.sha1(payload).digest()
    http = _block(
        [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK"
    )
    revisit = refers_to is not None if revisit is None else revisit
    content = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest.hex(), copy)),
        ("WARC-Date", WARC_DATE),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    head += [("WARC-Payload-Digest", _base32(digest)), ("WARC-Block-Digest", _base32(hashlib.sha1(content).digest()))]
    if revisit:
        head += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest.hex(), 0)),
        ]
        head += [("Refers-To-Page", str(refers_to))] if refers_to is not None else []
    if page_id is not None:
        head.append(("Page", str(page_id)))
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(content)))]
    return _block(head, "WARC/1.1") + content + b"\r\n\r\n"


def info(name: str) -> bytes:
    """The record that opens each file."""
    content = b"format: WARC File Format 1.1\r\n"
    head = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", name, 0)), ("WARC-Date", WARC_DATE),
        ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(content))),
    ]
    return _block(head, "WARC/1.1") + content + b"\r\n\r\n"


def compressed(content: bytes) -> bytes:
    """One gzip member, without time or name."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


# --- writing -----------------------------------------------------------------


def revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(key, digest, refers_to, copies) for each id and payload that is to be a revisit, or repeats.

    ``pages`` has key, digest and size. Only narrow rows are shuffled, and payloads
    are counted before that.
    """
    long = pages.where(F.col("size") >= least)
    once = long.groupBy("key", "digest").agg(F.count("*").alias("copies"))
    best = once.groupBy("digest").agg(
        F.max("key").alias("refers_to"), F.sum("copies").alias("n")
    ).where("n > 1")
    return once.join(best, "digest").select("key", "digest", "refers_to")


def _edges(pages: DataFrame, shards: int) -> list:
    """Ids that part the pages into shards of about equal weight, a row's being 1 and one for every ``ROW_BYTES``."""
    marks = [i / shards for i in range(1, shards)]
    if not marks:
        return []
    units = pages.select("key", F.explode(F.sequence(F.lit(0), F.floor(F.col("size") / ROW_BYTES).cast("int"))))
    found = units.agg(F.percentile_approx("key", marks, max(10_000, 20 * shards)).alias("m")).first().m
    return sorted(set(found or []))


def _place(edges: list, key: Column) -> Column:
    """How many of the rising ``edges`` are at most ``key``, by bisection; 0 for null."""
    if not edges:
        return F.lit(0)
    limits = F.lit(edges)

    def halve(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["low"] + s["high"], 1)
        behind = F.struct((middle + 1).alias("low"), s["high"].alias("high"))
        before = F.struct(s["low"].alias("low"), middle.alias("high"))
        step = F.when(F.element_at(limits, middle + 1) <= key, behind).otherwise(before)
        return F.when(s["low"] < s["high"], step).otherwise(s)

    start = F.struct(F.lit(0).alias("low"), F.lit(len(edges)).alias("high"))
    steps = F.array(*[F.lit(i) for i in range(len(edges).bit_length())])
    return F.aggregate(steps, start, halve, lambda s: s["low"])


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html",
          file_bytes: int = FILE_BYTES, shard_rows: int = SHARD_ROWS, least: int = REVISIT_BYTES) -> DataFrame:
    """Write an archive into ``folder``; its manifest, which is also written there."""
    spark = pages.sparkSession
    opened(folder)
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), payload.alias("payload"))
    narrow = land(rows.select("key", F.sha1("payload").alias("digest"), F.length("payload").alias("size")), "digests")
    weight = narrow.agg(F.sum(F.floor(F.col("size") / ROW_BYTES) + 1)).first()[0] or 0
    shards = max(1, min(MAX_SHARDS, -(-weight // shard_rows)))
    edges = _edges(narrow, shards)

    def place() -> Column:
        return _place(edges, F.col("key")).alias("shard")

    # Links travel with the pages, and come before those of their id and digest.
    links = revisits(narrow, least).select("key", "digest", "refers_to")
    nothing = F.lit(None)
    together = rows.select(
        place(), "key", F.lit(1).alias("kind"), "url", "payload",
        F.sha1("payload").alias("digest"), nothing.cast("long").alias("refers_to"),
    ).unionByName(links.select(
        place(), "key", F.lit(0).alias("kind"), nothing.cast("string").alias("url"),
        nothing.cast("binary").alias("payload"), "digest", "refers_to",
    ))
    # One shard to a task, which a hash of the shard's number would not give.
    ordered = together.repartitionById(shards, "shard").sortWithinPartitions("shard", "key", "digest", "kind", "url")
    temporary = f"{folder}/_temporary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt = f"{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}"
        yield from _write_shards(batches, f"{temporary}/{attempt}", file_bytes)

    parts = land(ordered.mapInArrow(run, MANIFEST), "warc-parts")
    return commit(spark, parts, folder)


def _write_shards(batches: Iterator[pa.RecordBatch], target: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    system, path = opened(target)
    system.create_dir(path, recursive=True)
    lines: list[dict] = []
    state: dict = {}

    def close() -> None:
        if state.get("out"):
            state["out"].close()
            lines.append({k: state[k] for k in ("file", "shard", "number", "records", "bytes")} | {"sha256": state["sum"].hexdigest()})
            state["out"] = None

    def put(content: bytes) -> None:
        state["out"].write(content)
        state["sum"].update(content)
        state["bytes"] += len(content)
        state["records"] += 1

    def open_file(shard: int, number: int) -> None:
        name = f"pages-{shard:05d}-{number:05d}.warc.gz"
        state.update(
            file=f"{target}/{name}", shard=shard, number=number, records=0, bytes=0,
            sum=hashlib.sha256(), out=system.open_output_stream(posixpath.join(path, name), compression=None),
        )
        put(compressed(info(name)))

    at, link, copy = None, None, 0
    for batch in batches:
        columns = [batch.column(n) for n in ("shard", "key", "kind", "url", "payload", "digest", "refers_to")]
        for i in range(batch.num_rows):
            shard, key, kind, url, payload, digest, refers_to = (c[i].as_py() for c in columns)
            if (key, digest) != at:
                at, link, copy = (key, digest), None, 0
            if kind == 0:
                link = (refers_to,)
                continue
            # The response is the first record of the id that the others refer to.
            revisit = link is not None and (link[0] != key or copy > 0)
            if not state.get("out") or state["shard"] != shard:
                close()
                open_file(shard, 0)
            elif state["bytes"] >= file_bytes:
                close()
                open_file(shard, state["number"] + 1)
            put(compressed(record(key, url, payload, link[0] if revisit else None, copy, revisit)))
            copy += 1
    close()
    names = ("file", "shard", "number", "records", "bytes", "sha256")
    types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in lines], t) for n, t in zip(names, types)], names=list(names))


def commit(spark: SparkSession, parts: DataFrame, folder: str) -> DataFrame:
    """Give the files of a landed manifest their final names, then write the manifest of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            final = []
            for path in batch.column("file").to_pylist():
                name = f"{folder}/{posixpath.basename(path)}"
                system, source = opened(path)
                goal = opened(name)[1]
                # Moved already, if an earlier attempt at this came so far.
                if system.get_file_info(source).type != fs.FileType.NotFound:
                    system.move(source, goal)
                elif system.get_file_info(goal).type == fs.FileType.NotFound:
                    raise FileNotFoundError(f"neither {path} nor {name} exists")
                final.append(name)
            yield batch.set_column(0, "file", pa.array(final, pa.string()))

    manifest = f"{folder}/manifest.parquet"
    parts.mapInArrow(run, MANIFEST).write.mode("overwrite").parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


# --- reading -----------------------------------------------------------------

RECORD = (
    "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, "
    "refers_to bigint, payload binary"
)


def members(stream) -> Iterator[bytes]:
    """The contents of a file's gzip members, one by one."""
    unpacker, held, rest = zlib.decompressobj(31), [], b""
    while True:
        piece = rest or stream.read(1 << 20)
        if not piece:
            break
        held.append(unpacker.decompress(piece))
        rest = b""
        if unpacker.eof:
            yield b"".join(held)
            rest = unpacker.unused_data
            unpacker, held = zlib.decompressobj(31), []
    if any(held):
        raise ValueError("the file ends within a record")


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])


def parsed(content: bytes) -> dict | None:
    """A record's row; None for other types. Raises where length or digest is wrong."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = _fields(head)
    size = int(fields["Content-Length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{fields['WARC-Record-ID']} has another length than stated")
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None
    if _base32(hashlib.sha1(block).digest()) != fields["WARC-Block-Digest"]:
        raise ValueError(f"{fields['WARC-Record-ID']} has another block digest than stated")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    response = fields["WARC-Type"] == "response"
    if response and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"{fields['WARC-Record-ID']} has another payload digest than stated")
    return {
        "page_id": int(fields["Page"]) if "Page" in fields else None,
        "url": fields.get("WARC-Target-URI"),
        "record_type": fields["WARC-Type"],
        # A revisit keeps the length of the payload that it leaves out.
        "payload_bytes": int(_fields(http)["Content-Length"]),
        "payload_digest": digest.hex(),
        "refers_to": int(fields["Refers-To-Page"]) if "Refers-To-Page" in fields else None,
        "payload": payload if response else None,
    }


def read(manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """The page records of an archive's files; a task reads the files of a shard as streams."""
    schema = RECORD if payloads else RECORD.replace(", payload binary", "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column("file").to_pylist():
                system, path = opened(file)
                rows, held = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for content in members(stream):
                        row = parsed(content)
                        if row:
                            rows.append(row)
                            held += len(row["payload"] or b"") if payloads else 0
                        if len(rows) >= 2000 or held >= 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    last = manifest.agg(F.max("shard")).first()[0]
    files = manifest.repartitionById((last or 0) + 1, "shard").select("file")
    return files.mapInArrow(run, schema)


def warc_query(pages: DataFrame) -> DataFrame:
    manifest = write(pages, new_path(pages.sparkSession, "archive"))
    return read(manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS target,
  payload_bytes >= {REVISIT_BYTES} AND row_number() OVER (
    PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST) > 1 AS again FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN target END AS refers_to FROM m"""
