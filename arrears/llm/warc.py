"""WARC archives with a globally ordered capture index made by external merging.

Every write task packs its pages into gzip-per-record WARC files and leaves a
run: its captures sorted by (URL key, timestamp, page).  The runs are cut by
ranges of that order; each range is merged from its pieces of all runs by a
loser tree, which gives one globally ordered capture history.  Archives are
read back through that index, record by record.

Of pages with equal payloads of at least ``MIN_REVISIT`` bytes the smallest
page_id keeps the payload; the others become revisit records that name it.

Cases: a null payload counts as empty; smaller payloads are always responses;
repeated rows (same page_id and payload) are one capture each, the copies of a
response's own page are responses too; a null url has an empty key; a null
time is ``FIRST_CAPTURE``; a page with a null page_id is a response of its own
without a record id (null when read back, first among equal keys and times),
never a revisit nor the keeper of a payload; an empty
table gives no archive and an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, scratch
from .token_shards import _open_fs, put_file

MIN_REVISIT = 100
FILE_BYTES = 256 << 20
#: Captures of a page table without times are dated from here, a second for each page_id.
FIRST_CAPTURE = 1_700_000_000
#: A null page_id while captures are in order.
_NO_ID = float("-inf")


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the root the winner.

    Taking the smallest item replays one path, log2(k) comparisons.
    """

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        k = max(1, len(runs))
        self.size = 1 << (k - 1).bit_length()
        self.head = [next(r, None) for r in runs] + [None] * (self.size - len(runs))
        self.tree = [0] * self.size
        win = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            a, b = win[2 * node], win[2 * node + 1]
            if self._less(b, a):
                a, b = b, a
            win[node], self.tree[node] = a, b
        self.tree[0] = win[1] if self.size > 1 else 0

    def _less(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def __iter__(self):
        head, tree = self.head, self.tree
        while (item := head[w := tree[0]]) is not None:
            yield item
            head[w] = next(self.runs[w], None)
            node = (w + self.size) >> 1
            while node:
                if self._less(tree[node], w):
                    tree[node], w = w, tree[node]
                node >>= 1
            tree[0] = w


def url_key(url: str | None) -> str:
    """Host labels reversed, then port, path and query in lower case: captures of a site sort together."""
    if not url:
        return ""
    try:
        p = urlsplit(url.strip())
        host, port = p.hostname or "", p.port
    except ValueError:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    query = "&".join(sorted(p.query.split("&"))) if p.query else ""
    return (",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")" + (p.path or "/") + (f"?{query}" if query else "")).lower()


def _date(t: int) -> str:
    return str(np.datetime64(int(t), "s")) + "Z"


def record(page_id: int | None, url: str | None, time: int, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit carries no payload, but its length and digest."""
    kind = "response" if refers_to is None else "revisit"
    target = re.sub(r"[\r\n]+", " ", url or "")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", *([] if page_id is None else [f"WARC-Record-ID: <urn:page:{page_id}>"]), f"WARC-Date: {_date(time)}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    body = http + (payload if refers_to is None else b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8") + body + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Headers and payload of one record; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    names = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:] if ": " in x)
    body = rest[: int(names["Content-Length"])]
    if len(body) != int(names["Content-Length"]) or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("record is cut short")
    payload = body.partition(b"\r\n\r\n")[2]
    digest = names["WARC-Payload-Digest"].removeprefix("sha256:")
    if names["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(names["X-Payload-Length"])):
        raise ValueError(f"{names.get('WARC-Record-ID')}: payload does not match its digest")
    page = lambda x: int(x.removeprefix("<urn:page:").removesuffix(">"))
    own, refers = names.get("WARC-Record-ID"), names.get("WARC-Refers-To")
    return {"page_id": page(own) if own else None, "payload_bytes": int(names["X-Payload-Length"]), "payload_digest": digest, "record_type": names["WARC-Type"], "refers_to": page(refers) if refers else None}


def roles(pages: DataFrame, payload: str = "html") -> DataFrame:
    """(page_id, url, time, payload, digest, refers_to) of each row: which captures become revisits."""
    raw = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    time = F.col("time").cast("long") if "time" in pages.columns else F.lit(FIRST_CAPTURE) + F.col("page_id")
    time = F.coalesce(time, F.lit(FIRST_CAPTURE))
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), time.alias("time"), raw.alias("payload"))
    digests = p.select("page_id", F.sha2("payload", 256).alias("digest"), F.length("payload").alias("n"))
    large = digests.where(F.col("n") >= MIN_REVISIT)
    first = large.groupBy("digest").agg(F.min("page_id").alias("keeper"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    revisits = large.join(first, "digest").where("page_id > keeper").groupBy(F.col("page_id").alias("_p"), F.col("digest").alias("_d")).agg(F.min("keeper").alias("refers_to"))
    p = p.withColumn("digest", F.sha2("payload", 256))
    return p.join(revisits, (F.col("page_id") == F.col("_p")) & (F.col("digest") == F.col("_d")), "left").drop("_p", "_d")


_INDEX = "url_key string, time long, page_id long, run int, file string, at long, size long"
_INDEX_SCHEMA = pa.schema([("url_key", pa.string()), ("time", pa.int64()), ("page_id", pa.int64()), ("run", pa.int32()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])


def write_archives(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the pages (as ``roles`` gives them); return the runs: index rows, sorted within each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run_id, part = TaskContext.get().partitionId(), 0
        blobs, at, rows = [], 0, []

        def close():
            nonlocal part, blobs, at
            if blobs:
                put_file(folder, f"capture-{run_id:06d}-{part:04d}.warc.gz", blobs)
                part, blobs, at = part + 1, [], 0

        for b in batches:
            for r in zip(*[b.column(c).to_pylist() for c in ("page_id", "url", "time", "payload", "digest", "refers_to")], strict=True):
                z = zlib.compressobj(2, zlib.DEFLATED, 31)
                blob = z.compress(record(*r)) + z.flush()
                rows.append((url_key(r[1]), r[2], _NO_ID if r[0] is None else r[0], run_id, f"capture-{run_id:06d}-{part:04d}.warc.gz", at, len(blob)))
                blobs.append(blob)
                at += len(blob)
                if at >= file_bytes:
                    close()
        close()
        rows.sort()  # one file's captures or a few: the run of this task
        for k in range(0, len(rows), 4096):
            yield _indexed(rows[k : k + 4096], _INDEX_SCHEMA)

    cols = ["page_id", "url", "time", "payload", "digest", "refers_to"]
    return pages.select(*cols).sortWithinPartitions("page_id", "digest", "url").mapInArrow(run, _INDEX)  # a repeated task writes the same file


def merge_runs(runs: DataFrame) -> DataFrame:
    """The captures of all runs in one global order, with ``position`` within their range of it.

    A task gets one range of the order: a sorted piece of each run that reaches into it, merged by a loser tree.
    """
    order = ["url_key", "time", "page_id", "run", "file", "at"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        t = pa.Table.from_batches(batches, schema=_INDEX_SCHEMA) if (batches := list(batches)) else None
        if t is None:
            return
        run = t["run"].to_numpy()
        bounds = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1], [True]]))
        part = TaskContext.get().partitionId()

        def piece(lo: int, hi: int) -> Iterator:
            for k in range(lo, hi, 1024):
                for r in zip(*[t[c].slice(k, min(1024, hi - k)).to_pylist() for c in _INDEX_SCHEMA.names], strict=True):
                    yield r if r[2] is not None else (*r[:2], _NO_ID, *r[3:])

        out, n = [], 0
        for item in LoserTree([piece(a, b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]):
            out.append((*item, part, n))
            n += 1
            if len(out) == 4096:
                yield _merged(out)
                out = []
        if out:
            yield _merged(out)

    dealt = runs.repartitionByRange(*order).sortWithinPartitions("run", *order)  # each run's piece stays a sorted run
    return dealt.mapInArrow(merge, _INDEX + ", range int, position long")


def _merged(rows: list[tuple]) -> pa.RecordBatch:
    return _indexed(rows, _INDEX_SCHEMA.append(pa.field("range", pa.int32())).append(pa.field("position", pa.int64())))


def _indexed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    cols[2] = [None if x == _NO_ID else x for x in cols[2]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types, strict=True)], schema=schema)


def read_archives(index: DataFrame, folder: str, parse: Callable[[bytes], dict] = parse_record) -> DataFrame:
    """Read each indexed capture from its file."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url_key", pa.string()), ("time", pa.int64()), ("range", pa.int32()), ("position", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open_fs(folder)
        name, f = None, None
        for b in batches:
            out = []
            for r in b.to_pylist():
                if r["file"] != name:
                    if f is not None:
                        f.close()
                    name = r["file"]
                    f = fs.open_input_file(f"{path}/{name}")
                f.seek(r["at"])
                out.append(parse(zlib.decompress(f.read(r["size"]), 31)) | {k: r[k] for k in ("url_key", "time", "range", "position")})
                if len(out) == 4096:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if f is not None:
            f.close()

    near = index.repartition("file", F.floor(F.col("at") / (16 << 20))).sortWithinPartitions("file", "at")
    return near.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, time long, range int, position long")


def archive(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write the pages to archives; (globally ordered index, folder)."""
    folder = folder or scratch(pages.sparkSession, "warc")
    runs = cut(write_archives(roles(pages), folder))
    return cut(merge_runs(runs)), folder


def archive_report(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page, from the archives read back."""
    return read_archives(*archive(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
