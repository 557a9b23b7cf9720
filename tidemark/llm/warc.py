"""WARC archives with a globally ordered capture index.

1. Archives: each task writes its pages as gzip-compressed WARC records into
   archive files of the shared folder.  Records whose payload equals an earlier
   page's (digest over all pages, payload of ``MIN_REVISIT_BYTES`` or more) are
   revisits that refer to the page with the smallest id.
2. Runs: tasks read the archives back and write one index run per archive,
   sorted by (URL key, timestamp, page id), with a sparse table of keys.
3. Merge: runs are merged k ways with a loser tree.  Passes of at most
   ``FAN_IN`` runs a task go on until ``FAN_IN`` runs are left; the last pass
   is dealt out by key ranges taken from the runs' sparse tables.  A task holds
   one block of each run it merges, so its memory does not grow with the data,
   and a URL with very many captures is split between ranges by timestamp.

Files of a failed task attempt are never read: only the manifest that Spark
commits names files, and every attempt writes under a name of its own.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scratch import filesystem, thinned, written
from tidemark.session import shared_dir

MIN_REVISIT_BYTES = 100
#: Runs merged by one task.
FAN_IN = 64
#: Keys of a run that the key ranges are made from, at most.
KEYS_PER_RUN = 256
#: Captures of one key range of the last merge pass, about.
RANGE_RECORDS = 500_000
#: Index lines per block of a run; a merge holds one block per run.
BLOCK_LINES = 2000
#: An archive file is closed when it is at least this long.
ARCHIVE_BYTES = 1 << 28
EPOCH = datetime(2024, 1, 1, tzinfo=UTC)


def url_key(url: str | None) -> str:
    """Sort-friendly form: host labels reversed, then path and query; scheme, ``www.``, port, case and fragment do not count."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").lower()
    except ValueError:  # a broken address is its own key
        return (url or "").lower()
    host = host.removeprefix("www.")
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + ")" + path.lower()


def timestamp(page_id: int | None) -> str:
    """Capture time: the table has none, so pages count seconds from ``EPOCH`` by their id."""
    seconds = (page_id or 0) % (1 << 32)
    return (EPOCH + timedelta(seconds=seconds)).strftime("%Y%m%d%H%M%S")


def revisits(pages: DataFrame) -> DataFrame:
    """``(page_id, digest, refers_to)`` of pages whose payload a smaller page_id has too, once each.

    Repeated rows go before the join, so nothing above it asks for its order and
    a payload that very many pages share is split.
    """
    digests = written(pages.where("page_id is not null")
                      .select("page_id", F.octet_length(_payload()).alias("bytes"), F.sha2(_payload(), 256).alias("digest")),
                      "warc-digests").where(F.col("bytes") >= MIN_REVISIT_BYTES)
    first = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")) \
        .where("refers_to < last").select("digest", "refers_to")
    pages_of = thinned(digests, "digest", first, "digest").select("page_id", "digest").distinct()
    return pages_of.join(first, "digest").where("page_id > refers_to").select("page_id", "digest", "refers_to")


def _payload():
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def _header(lines: list[tuple[str, str]]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n").encode()


def _record(page_id: int | None, url: str | None, html: str | None, refers_to: int | None) -> bytes:
    payload = (html or "").encode()
    digest = hashlib.sha256(payload).hexdigest()
    when = datetime.strptime(timestamp(page_id), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"),
             ("WARC-Date", when), ("WARC-Target-URI", json.dumps(url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
             ("X-Page-Id", json.dumps(page_id))]
    if refers_to is not None:
        lines += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                  ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>"),
                  ("X-Refers-To-Page-Id", json.dumps(refers_to))]
    lines += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    raw = _header(lines) + block + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=1, mtime=0)


MANIFEST = "path string, records long, bytes long"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) and return the manifest of archive files."""
    plan = revisits(pages)
    rows = pages.select("page_id", "url", "html", F.sha2(_payload(), 256).alias("digest")) \
        .join(plan, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        out = name = None
        records = size = 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                record = _record(page_id, url, html, refers_to)
                out.write(record)
                records, size = records + 1, size + len(record)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((name, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, records, size))
        yield pa.RecordBatch.from_pylist([{"path": n, "records": r, "bytes": b} for n, r, b in done],
                                         pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return written(rows.mapInArrow(run, MANIFEST), "warc-manifest")


def read_archive(stream) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, length, WARC headers, block)`` of each record of an archive file."""
    offset, pending = 0, b""
    while True:
        # one gzip member per record
        unzip, parts, length = zlib.decompressobj(31), [], 0
        while not unzip.eof:
            if not pending:
                pending = stream.read(1 << 20)
                if not pending:
                    if length:
                        raise ValueError(f"truncated record at {offset}")
                    return
            parts.append(unzip.decompress(pending))
            length += len(pending) - len(unzip.unused_data)
            pending = unzip.unused_data
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield offset, length, headers, rest[:int(headers["Content-Length"])]
        offset += length


class RunWriter:
    """A sorted run: blocks of compressed index lines, then the table of their first keys and places."""

    def __init__(self, folder: str, block_lines: int):
        self.store, root = filesystem(folder)
        self.path, self.block_lines = f"{root}/{uuid.uuid4().hex}.run", block_lines
        self.out = self.store.open_output_stream(self.path, compression=None)
        self.table: list[tuple[list, int, int]] = []
        self.lines: list[list] = []
        self.at = self.records = 0

    def add(self, entry: list) -> None:
        self.lines.append(entry)
        self.records += 1
        if len(self.lines) >= self.block_lines:
            self._flush()

    def _flush(self) -> None:
        if self.lines:
            raw = zlib.compress(json.dumps(self.lines).encode(), 1)
            self.table.append((self.lines[0][:3], self.at, len(raw)))
            self.out.write(raw)
            self.at += len(raw)
            self.lines = []

    def close(self) -> dict:
        self._flush()
        raw = zlib.compress(json.dumps(self.table).encode(), 1)
        self.out.write(raw + len(raw).to_bytes(8, "big"))
        self.out.close()
        keys = [k for k, _, _ in self.table]
        return {"path": self.path.rsplit("/", 1)[-1], "records": self.records,
                "keys": json.dumps(keys[::-(-len(keys) // KEYS_PER_RUN) or 1])}


def _table(store: fs.FileSystem, path: str) -> list[tuple[list, int, int]]:
    size = store.get_file_info(path).size
    with store.open_input_file(path) as f:
        n = int.from_bytes(f.read_at(8, size - 8), "big")
        return json.loads(zlib.decompress(f.read_at(n, size - 8 - n)))


def read_run(folder: str, name: str, low: list | None, high: list | None) -> Iterator[list]:
    """Entries of a run with low <= key < high, a block at a time."""
    store, root = filesystem(folder)
    table = _table(store, f"{root}/{name}")
    keys = [k for k, _, _ in table]
    start = max(bisect_left(keys, low) - 1, 0) if low else 0
    with store.open_input_file(f"{root}/{name}") as f:
        for key, at, size in table[start:]:
            if high and key >= high:
                return
            for entry in json.loads(zlib.decompress(f.read_at(size, at))):
                if high and entry[:3] >= high:
                    return
                if not low or entry[:3] >= low:
                    yield entry


class LoserTree:
    """k-way merge: inner nodes keep the loser of their match, so each step replays one path."""

    def __init__(self, runs: list[Iterator[list]]):
        self.runs = runs
        self.k = len(runs)
        self.heads = [next(r, None) for r in runs]
        self.tree = [-1] * max(self.k, 1)
        for i in range(self.k):
            self._play(i)

    def _wins(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[:3], a) < (y[:3], b)

    def _play(self, i: int) -> None:
        winner, node = i, (i + self.k) // 2
        while node:
            if self.tree[node] < 0:  # first round: wait for the other side
                self.tree[node] = winner
                return
            if self._wins(self.tree[node], winner):
                winner, self.tree[node] = self.tree[node], winner
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator[list]:
        while self.k and self.heads[self.tree[0]] is not None:
            i = self.tree[0]
            yield self.heads[i]
            self.heads[i] = next(self.runs[i], None)
            self._play(i)


RUN_SCHEMA = "path string, records long, keys string"
_RUN = pa.schema([("path", pa.string()), ("records", pa.int64()), ("keys", pa.string())])


def index_runs(manifest: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Read each archive back, check its digests, and write its sorted index run.

    An entry is [URL key, timestamp, page id, url, payload bytes, digest, type,
    refers to, archive, offset, length]; the entries of one archive, not its
    payloads, are held while sorting.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                entries = []
                with store.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for offset, length, headers, block in read_archive(stream):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(http.rsplit(b": ", 1)[1])
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        kind = headers["WARC-Type"]
                        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"damaged record in {name} at {offset}")
                        page_id, url = json.loads(headers["X-Page-Id"]), json.loads(headers["WARC-Target-URI"])
                        refers = json.loads(headers.get("X-Refers-To-Page-Id", "null"))
                        when = "".join(c for c in headers["WARC-Date"] if c.isdigit())
                        entries.append([url_key(url), when, [page_id is None, page_id or 0], url, size, digest, kind,
                                        refers, name, offset, length])
                entries.sort(key=lambda e: e[:3])
                writer = RunWriter(folder, block_lines)
                for e in entries:
                    writer.add(e)
                yield pa.RecordBatch.from_pylist([writer.close()], _RUN)

    files = manifest.select("path")
    return written(files.repartition(max(1, manifest.count()), "path").mapInArrow(run, RUN_SCHEMA), "warc-runs")


CAPTURES = ("range int, place long, url_key string, captured string, page_id long, url string, payload_bytes long, "
            "payload_digest string, record_type string, refers_to long, archive string, offset long, length long")


def merge_runs(runs: DataFrame, folder: str, fan_in: int = FAN_IN, ranges: int | None = None,
               block_lines: int = BLOCK_LINES) -> DataFrame:
    """All captures ordered by (range, place), which is the order of (URL key, timestamp, page id)."""
    spark = runs.sparkSession

    def merge_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names in batch.column(0).to_pylist():
                writer = RunWriter(folder, block_lines)
                for entry in LoserTree([read_run(folder, n, None, None) for n in names]):
                    writer.add(entry)
                yield pa.RecordBatch.from_pylist([writer.close()], _RUN)

    n = runs.count()
    while n > fan_in:  # a pass over whole runs, fan_in at a time
        groups = -(-n // fan_in)
        dealt = runs.withColumn("slot", F.pmod(F.xxhash64("path"), F.lit(groups))) \
            .withColumn("part", F.floor((F.row_number().over(Window.partitionBy("slot").orderBy("path")) - 1) / fan_in)) \
            .groupBy("slot", "part").agg(F.collect_list("path").alias("paths"))
        dealt = written(dealt.select("paths"), "warc-merge-plan")
        tasks = dealt.count()
        if tasks >= n:
            break
        runs = written(dealt.repartition(tasks).mapInArrow(merge_group, RUN_SCHEMA), "warc-runs")
        n = runs.count()

    # at most fan_in runs: their names and a bounded number of their keys make the key ranges
    total = runs.agg(F.sum("records")).first()[0] or 0
    wanted = ranges or max(spark.sparkContext.defaultParallelism, total // RANGE_RECORDS)
    names, sample = [], []
    for row in runs.orderBy("path").toLocalIterator():
        names.append(row["path"])
        sample += json.loads(row["keys"])
    sample.sort()
    cuts = [sample[i * len(sample) // wanted] for i in range(1, wanted)] if sample else []
    bounds = [json.dumps(k) for i, k in enumerate(cuts) if not i or k != cuts[i - 1]]
    edges = [None, *bounds, None]
    plan = spark.createDataFrame([(i, edges[i], edges[i + 1]) for i in range(len(edges) - 1)],
                                 "range int, low string, high string").repartition(len(edges) - 1, "range")

    def merge_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                low, high = (json.loads(x) if x else None for x in (low, high))
                out, place = [], 0
                for e in LoserTree([read_run(folder, n, low, high) for n in names]):
                    out.append((number, place, e[0], e[1], None if e[2][0] else e[2][1], *e[3:]))
                    place += 1
                    if len(out) >= 4096:
                        yield _captures(out)
                        out = []
                yield _captures(out)

    return plan.mapInArrow(merge_range, CAPTURES)


def _captures(rows: list[tuple]) -> pa.RecordBatch:
    types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    names = [c.strip().split(" ") for c in CAPTURES.split(",")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), types[t]) for c, (_, t) in zip(columns, names)],
                                      [n for n, _ in names])


def capture_history(pages: DataFrame, folder: str | None = None, fan_in: int = FAN_IN,
                    ranges: int | None = None, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Archive ``pages`` (page_id, url, html) and return all captures in global order.

    One row per page: url_key, captured, page_id, url, payload_bytes,
    payload_digest, record_type, refers_to and the record's place in the
    archives, read back from them.

    Cases: a null html is an empty payload; payloads under
    ``MIN_REVISIT_BYTES`` are always responses; a null url has an empty key; a
    null page_id is always a response, last among equal keys; rows that repeat
    a page_id with one payload get the same decision each; an empty table gives
    no rows; other columns are ignored.
    """
    folder = folder or shared_dir(pages.sparkSession, "llm-warc")
    manifest = write_archives(pages, folder)
    return merge_runs(index_runs(manifest, folder, block_lines), folder, fan_in, ranges, block_lines)
