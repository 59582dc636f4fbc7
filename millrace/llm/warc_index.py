"""WARC archives with revisits, and a capture index merged from sorted runs.

Writing: Spark writes one record per page; records end with two line ends, which is the
separator of the text sink, so each file is a plain WARC file (gzip around it). Of equal
payloads from a least size on, the one with the largest id is stored and the others
revisit it.

Reading: each archive is parsed and gives a run of captures, sorted by URL key, time and
record. Runs are cut by sampled key ranges (a hot URL key is cut inside, by time and
record), and every range is merged by a loser tree over its runs, so the captures of a
key come out in order, and ranges follow each other.

Defined results: a null payload is empty, a null URL is the empty URL, line ends in a URL
are percent-encoded. A null id is never the one that others refer to. Repeated rows
are records of their own; rows that repeat the largest id are all stored. Null ids are read
back as the empty record name. An empty table gives an empty archive and index. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import materialize, new_scratch

MIN_REVISIT_BYTES = 1000
#: Bounds the size of an archive file and of a merge.
RECORDS_PER_FILE = 5000
CAPTURES_PER_MERGE = 50_000
#: Earlier archives than this are not known to the default capture time.
TIME_RANGE = 1 << 31

_RUN = "url_key string, captured string, record string, file string, offset long, length long, " \
    "record_type string, refers_to string, payload_bytes long, payload_digest string"
_END = b"\r\n\r\n"


def _lines(*parts: tuple[str, Column]) -> Column:
    return F.concat(*(x for name, value in parts for x in (F.lit(name), value, F.lit("\r\n"))))


def records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", captured: Column | None = None
) -> DataFrame:
    """One WARC record (``value``) per page, without the separator at its end."""
    seconds = F.pmod(F.coalesce(F.col(page_id).cast("long"), F.lit(0)), F.lit(TIME_RANGE))
    when = F.timestamp_seconds(seconds) if captured is None else captured
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(page_id).alias("id"),
        F.coalesce(F.regexp_replace(url, r"[\r\n]", "%0A"), F.lit("")).alias("url"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
        body.alias("body"),
        F.sha1(body.cast("binary")).alias("digest"),
        F.octet_length(body).alias("bytes"),
    )
    stored = (
        rows.where(F.col("bytes") >= MIN_REVISIT_BYTES)
        .groupBy("digest", "bytes")
        .agg(F.max("id").alias("stored_id"), F.count("*").alias("n"))
        .where("n > 1 and stored_id is not null")
        .drop("n")
    )
    marked = rows.join(stored, ["digest", "bytes"], "left")
    revisit = F.col("stored_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("stored_id"))
    http = _lines(
        ("HTTP/1.1 200 OK", F.lit("")),
        ("Content-Type: text/html; charset=utf-8", F.lit("")),
        ("Content-Length: ", F.col("bytes").cast("string")),
        ("", F.lit("")),
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        _lines(
            ("WARC/1.1", F.lit("")),
            ("WARC-Type: ", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID: ", name(F.col("id"))),
            ("WARC-Date: ", F.col("captured")),
            ("WARC-Target-URI: ", F.col("url")),
            ("WARC-Payload-Digest: sha1:", F.col("digest")),
        ),
        F.when(
            revisit,
            _lines(
                ("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", F.lit("")),
                ("WARC-Refers-To: ", name(F.col("stored_id"))),
            ),
        ).otherwise(F.lit("")),
        _lines(
            ("Content-Type: application/http; msgtype=response", F.lit("")),
            ("Content-Length: ", F.octet_length("block").cast("string")),
            ("", F.lit("")),
        ),
    )
    return marked.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))


def write_archives(value: DataFrame, path: str) -> None:
    """Write records as WARC files below ``path``."""
    writer = value.write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def url_key(url: str) -> str:
    """Sort key of a URL: host labels from the right, then path and query, in lower case."""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    labels = host.removeprefix("www.").split(".")[::-1]
    end = f":{port}" if port not in (None, 80, 443) else ""
    query = "?" + "&".join(sorted(parts.query.split("&"))) if parts.query else ""
    return f"{','.join(labels)}{end}){parts.path or '/'}{query}"


def parse_archive(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes, bytes]]:
    """Records of an archive: offset, length, headers, HTTP head, payload."""
    at = 0
    while at < len(data):
        stop = data.index(_END, at) + len(_END)
        first, *lines = data[at:stop].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        headers = dict(line.split(": ", 1) for line in lines if line)
        end = stop + int(headers["Content-Length"])
        body = data.index(_END, stop) + len(_END)
        yield at, end - at, headers, data[stop:body], data[body:end]
        if data[end : end + len(_END)] != _END:
            raise ValueError(f"no end of record at {end}")
        at = end + len(_END)


def _capture(file: str, offset: int, length: int, headers: dict, http: bytes, payload: bytes) -> tuple:
    kind = headers["WARC-Type"]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http.split(b"Content-Length: ")[1].split(b"\r\n")[0])
    if kind == "response" and (size != len(payload) or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    name = lambda value: value.removeprefix("<urn:page:").removesuffix(">")
    return (url_key(headers["WARC-Target-URI"]), headers["WARC-Date"], name(headers["WARC-Record-ID"]), file,
            offset, length, kind, name(headers.get("WARC-Refers-To", "")), size, digest)


_RUN_TYPES = pa.schema([
    (name, pa.int64() if kind == "long" else pa.string())
    for name, kind in (column.split() for column in _RUN.split(", "))
])


def _sorted_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            data = zlib.decompress(content.as_py(), 31)
            run = sorted(_capture(path.as_py(), *record) for record in parse_archive(data))
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*run), _RUN_TYPES.types)], schema=_RUN_TYPES
            ) if run else pa.RecordBatch.from_pylist([], schema=_RUN_TYPES)


def capture_runs(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archives below ``path``, every archive a sorted run."""
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return archives.select("path", "content").mapInArrow(_sorted_runs, _RUN)


class LoserTree:
    """Merges sorted sequences; a step costs one comparison per level of the tree.

    Inner nodes keep the loser of their match, the winner goes up. A used-up
    sequence loses every match.
    """

    def __init__(self, runs: Sequence[Sequence]):
        self.runs = runs
        self.place = [0] * len(runs)
        self.losers = [-1] * len(runs)
        self.winner = self._play(1) if runs else -1

    def _before(self, a: int, b: int) -> bool:
        if self.place[a] >= len(self.runs[a]):
            return False
        if self.place[b] >= len(self.runs[b]):
            return True
        return (self.runs[a][self.place[a]], a) < (self.runs[b][self.place[b]], b)

    def _play(self, node: int) -> int:
        if node >= len(self.runs):
            return node - len(self.runs)
        a, b = self._play(2 * node), self._play(2 * node + 1)
        if not self._before(a, b):
            a, b = b, a
        self.losers[node] = b
        return a

    def __iter__(self):
        while self.runs and self.place[self.winner] < len(self.runs[self.winner]):
            best = self.winner
            yield self.runs[best][self.place[best]]
            self.place[best] += 1
            node = (best + len(self.runs)) // 2
            while node:
                if self._before(self.losers[node], best):
                    self.losers[node], best = best, self.losers[node]
                node //= 2
            self.winner = best


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of one key range; a run starts where the order of arrival falls."""
    rows = pa.Table.from_batches(list(batches), schema=_RUN_TYPES)
    keys = list(zip(*(rows.column(name).to_pylist() for name in ("url_key", "captured", "record"))))
    runs: list[list[tuple]] = []
    for at, key in enumerate(keys):
        if not runs or key < runs[-1][-1][0]:
            runs.append([])
        runs[-1].append((key, at))
    order = pa.array([at for _, at in LoserTree(runs)], pa.int64())
    yield from rows.take(order).combine_chunks().to_batches()


def merge_runs(runs: DataFrame, captures_per_merge: int = CAPTURES_PER_MERGE) -> DataFrame:
    """All captures in global order by URL key, time and record; ``runs`` is read twice."""
    ranges = max(1, -(-runs.count() // captures_per_merge))
    key = ["url_key", "captured", "record"]
    return runs.repartitionByRange(ranges, *key).mapInArrow(_merge, _RUN)


def archive_index(pages: DataFrame, **columns) -> DataFrame:
    """Write archives of ``pages``, read them back, and merge their capture runs."""
    spark = pages.sparkSession
    path = new_scratch(spark, "warc")
    write_archives(records(pages, **columns), path)
    return merge_runs(materialize(capture_runs(spark, path), "capture-runs"))


def histories(index: DataFrame) -> DataFrame:
    """Number of captures, first and last time of every URL key."""
    return index.groupBy("url_key").agg(
        F.count("*").alias("captures"), F.min("captured").alias("first"), F.max("captured").alias("last")
    )
