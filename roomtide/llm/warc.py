"""WARC archives with an externally merged capture index.

Every page becomes a record of a gzip-per-record WARC/1.1 file. Of pages with equal payloads
the one with the largest id is the response and the others are revisits that name it. Each
writing task sorts its captures by URL key and time, writes one archive in that order and
reports the lines of its index: a sorted run. The runs are dealt to ranges of (URL key, time,
page), and each range is merged by a loser tree over the runs that reach it; ranges in order,
positions inside them and the rows of earlier ranges give the global order of all captures.

Decisions are made on digests (native SHA-1) before any payload moves, groups of copies are
counted map-side, and payloads are dealt by page id, so a payload that a third of all pages
share is no hot key. The number of ranges follows the number of captures. Archives have names
of one attempt each; only those that a finished task reports are read.

Cases: null html is an empty payload; a null or empty URL has no target header and an empty
key; several rows with the largest id of a group are all responses; a null id counts as the
smallest and refers to itself only where all are null; without a capture time, pages are dated
by their id; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roomtide.llm.common import new_folder, open_folder, shared

EPOCH = 1_704_067_200  # Fixed value: 2024-01-01T00:00:00Z, the time of page 0 where none is given
DAY_CYCLE = 86_400 * 366
RANGE_ROWS = 50_000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 5
RECORDS_AT_ONCE = 10_000


def url_key(url: str | Column) -> Column:
    """Host labels in reverse order, a closing bracket, then path and query; lower-case host, no www and no fragment."""
    whole = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    pattern = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)([^#]*)"
    host = F.regexp_replace(F.lower(F.regexp_extract(whole, pattern, 1)), r"^www\.", "")
    rest = F.regexp_extract(whole, pattern, 2)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest))
    return F.when(whole.rlike(pattern), key).otherwise(whole)


def decide(pages: DataFrame) -> DataFrame:
    """page_id, digest and refers_to of the pages that repeat the payload of a later one."""
    digests = shared(pages.select("page_id", F.sha1("payload").alias("digest")), "digests")
    copies = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    copies = shared(copies.select("digest", "refers_to"), "copied-payloads")
    repeats = digests.join(copies, "digest").where("refers_to is not null and not (page_id <=> refers_to)")
    return repeats.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to").distinct()


def header_value(text: str) -> str:
    """One line: controls and blanks would end or split a header."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def record(page_id, url: str, captured: int, payload: bytes, digest: str, refers_to) -> bytes:
    """One record. A revisit keeps the HTTP headers, with the length of the payload it leaves out."""
    import datetime

    when = datetime.datetime.fromtimestamp(captured, datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>"]
    if url:
        lines.append(f"WARC-Target-URI: {header_value(url)}")
    lines += [f"WARC-Date: {when}", f"WARC-Payload-Digest: sha1:{digest}"]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


RUN = "run bigint, seq bigint, url_key string, captured bigint, page_id bigint, archive string, offset bigint, size bigint"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write the archives; the index lines of every run, in the order of the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, seq, offset, sink = TaskContext.get().partitionId(), 0, 0, None
        name = f"{folder}/captures-{number:06d}-{uuid.uuid4().hex}.warc.gz"
        try:
            for batch in batches:
                rows = []
                for key, captured, page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if sink is None:
                        files, path = open_folder(name)
                        files.create_dir(path.rpartition("/")[0], recursive=True)
                        sink = files.open_output_stream(path, compression=None)
                    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    packed = packer.compress(record(page_id, url, captured, payload, digest, refers_to)) + packer.flush()
                    sink.write(packed)
                    rows.append((number, seq, key, captured, page_id, name, offset, len(packed)))
                    seq, offset = seq + 1, offset + len(packed)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.string() if i in (2, 5) else pa.int64()) for i, c in enumerate(zip(*rows))],
                        names=["run", "seq", "url_key", "captured", "page_id", "archive", "offset", "size"],
                    )
        finally:
            if sink is not None:
                sink.close()

    order = ["url_key", "captured", "page_id"]
    sorted_runs = pages.sortWithinPartitions(*order).select(*order, "url", "payload", "refers_to")
    return shared(sorted_runs.mapInArrow(run, RUN), "capture-runs")


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, the winner plays on."""

    def __init__(self, sources: list[Iterator[tuple]]):
        self.sources = sources
        self.k = len(sources)
        self.heads = [next(s, None) for s in sources]
        self.losers = [-1] * max(1, self.k)
        self.winner = -1
        for leaf in range(self.k):
            self.play(leaf, filling=True)

    def beats(self, a: int, b: int) -> bool:
        left, right = self.heads[a], self.heads[b]
        if left is None or right is None:
            return right is None and (left is not None or a < b)
        return (left, a) < (right, b)

    def play(self, leaf: int, filling: bool = False) -> None:
        """Carry ``leaf`` to the top, leaving losers behind; while filling, stop at a node not yet played."""
        node = (leaf + self.k) // 2
        while node > 0:
            rival = self.losers[node]
            if rival < 0 and filling:
                self.losers[node] = leaf
                return
            if rival >= 0 and self.beats(rival, leaf):
                self.losers[node], leaf = leaf, rival
            node //= 2
        self.winner = leaf

    def __iter__(self) -> Iterator[tuple]:
        while self.k and self.heads[self.winner] is not None:
            yield self.heads[self.winner]
            self.heads[self.winner] = next(self.sources[self.winner], None)
            self.play(self.winner)


def merge_runs(runs: DataFrame, rows: int) -> DataFrame:
    """The index in global order: range_no, place in the range, archive, offset and size of every capture."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sources: list[list[tuple]] = []
        last = None
        for batch in batches:
            for run_no, *line in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6, 7))):
                if run_no != last:
                    sources.append([])
                    last = run_no
                key, captured, page_id = line[:3]
                sources[-1].append(((key, captured, page_id is not None, page_id or 0), *line))
        number = TaskContext.get().partitionId()
        lines = [(number, place, *line[1:]) for place, line in enumerate(LoserTree([iter(s) for s in sources]))]
        if lines:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string() if i in (2, 5) else pa.int64()) for i, c in enumerate(zip(*lines))], names=MERGED
            )

    ranges = max(1, -(-rows // RANGE_ROWS))
    dealt = runs.repartitionByRange(ranges, "url_key", "captured", "page_id").sortWithinPartitions("run", "seq")
    made = "range_no bigint, place bigint, url_key string, captured bigint, page_id bigint, archive string, offset bigint, size bigint"
    return shared(dealt.mapInArrow(merge, made), "capture-index")


MERGED = ["range_no", "place", "url_key", "captured", "page_id", "archive", "offset", "size"]


def ranked(index: DataFrame) -> DataFrame:
    """The merged index with index_rank, from 0 over all captures."""
    sizes = index.groupBy("range_no").agg(F.count("*").alias("n"))
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    starts = sizes.select("range_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return index.join(starts, "range_no").select("archive", "offset", "url_key", (F.col("start") + F.col("place")).alias("index_rank"))


def records_of(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of every gzip member of an archive, one at a time."""
    offset, rest = 0, b""
    while True:
        unpack = zlib.decompressobj(31)
        parts, used = [], 0
        while not unpack.eof:
            chunk = rest or stream.read(1 << 20)
            if not chunk:
                if used:
                    raise ValueError("an archive ends inside a record")
                return
            parts.append(unpack.decompress(chunk))
            rest = unpack.unused_data
            used += len(chunk) - len(rest)
        yield offset, b"".join(parts)
        offset += used


def headers_of(lines: bytes) -> dict[str, str]:
    found = (line.partition(":") for line in lines.decode("utf-8").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in found}


def page_of(uri: str | None) -> int | None:
    number = (uri or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=RECORD)


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record of the archives named in the column ``archive``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                files, path = open_folder(name)
                rows = []
                with files.open_input_stream(path, compression=None) as stream:
                    for offset, data in records_of(stream):
                        head, _, rest = data.partition(b"\r\n\r\n")
                        header = headers_of(head)
                        block = rest[: int(header["content-length"])]
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest, kind = header["warc-payload-digest"].removeprefix("sha1:"), header["warc-type"]
                        size = int(headers_of(http)["content-length"])
                        if kind == "response" and (size != len(payload) or digest != base64.b32encode(hashlib.sha1(payload).digest()).decode()):
                            raise ValueError(f"{name} is damaged at {offset}")
                        rows.append((page_of(header["warc-record-id"]), size, digest, kind, page_of(header.get("warc-refers-to")), name, offset))
                        if len(rows) == RECORDS_AT_ONCE:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    made = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, archive string, offset bigint"
    # A name is a few bytes and an archive is large, so the number of tasks is given: one for each archive.
    # What they read is written, because its size cannot be told from the names.
    names = shared(archives.select("archive").distinct(), "archive-names")
    return shared(names.repartitionByRange(max(1, names.count()), "archive").mapInArrow(run, made), "records")


RECORD = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "archive", "offset"]


def archive_and_index(
    spark: SparkSession, df: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", captured: str | None = None
) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url_key and index_rank, read back from the archives."""
    number = F.col(page_id).cast("long")
    dated = F.pmod(F.coalesce(number, F.lit(0)), F.lit(DAY_CYCLE)) + EPOCH
    pages = df.select(
        number.alias("page_id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
        (F.coalesce(F.unix_timestamp(captured), dated) if captured else dated).cast("long").alias("captured"),
    ).withColumn("url_key", url_key("url"))
    repeats = decide(pages)
    marked = pages.withColumn("digest", F.sha1("payload"))
    marked = marked.join(repeats, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest")), "left")
    runs = write_archives(marked, new_folder(spark, "archives"))
    index = merge_runs(runs, runs.count())
    rows = read_archives(runs)
    found = rows.join(ranked(index), ["archive", "offset"])
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "index_rank")
