"""WARC archives of captures, and their index merged into globally ordered histories.

Writing: every row becomes one WARC/1.1 record. Records with equal payloads of at least
``MIN_REVISIT`` bytes are stored once, as the response with the smallest ``page_id``; the
others are revisit records that refer to it. Spark's text writer puts the records into
plain archive files (a record ends with the four bytes that the format asks for), so
archives lie in the shared folder and are rewritten with their task.

Reading: each archive is parsed by content length into index rows and sorted by URL key
and timestamp: a run. Runs are dealt out by key ranges, and in each range the sorted runs
are merged by a loser tree. Ranges follow one another, so the whole index is in order.
A URL with very many captures is split, as timestamp and ``page_id`` are part of the range.

A null payload is empty. A row without URL has the empty key, a row without timestamp
the epoch. Rows that share the smallest ``page_id`` of their payload are all responses;
rows without ``page_id`` refer to one that has it, and are responses where none has.
Line breaks in a URL are written percent-encoded. Dates are written in UTC, in whole seconds.
An empty table gives no rows. Only ``page_id``, ``url``, ``captured`` and ``html`` are read, so
further columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairforge.functions.joins import lookup_join
from pairforge.functions.scratch import scratch_path, stage
from pairforge.llm.words import batches_of

MIN_REVISIT = 100
#: Records of an archive, and index rows that one task merges.
RECORDS_PER_ARCHIVE, ROWS_PER_RANGE = 1_000, 100_000
BREAK = "\r\n"

INDEX = (
    "url_key string, captured timestamp, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, "
    "payload_digest string, archive string, record_offset bigint, record_length bigint"
)


def url_key(url: Column) -> Column:
    """Host labels in reverse order, then path and query: captures of a site lie together."""
    clean = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://(www\d*\.)?", "")
    host = F.regexp_extract(clean, r"^([^/?#:]*)", 1)
    rest = F.regexp_replace(F.regexp_replace(clean, r"^[^/?#]*", ""), r"#.*$", "")
    return F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest), F.lit(""))


def with_revisits(pages: DataFrame) -> DataFrame:
    """Payload, its length and digest, and the response each duplicate refers to.

    Digests are counted map-side; only those of several rows are joined back.
    """
    rows = pages.select(
        "page_id", "url", "captured", F.coalesce("html", F.lit("")).alias("payload")
    ).withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).withColumn("payload_digest", F.sha2("payload", 256))
    several = rows.where(F.col("payload_bytes") >= MIN_REVISIT).groupBy("payload_digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("_n")
    )
    several = stage(several.where("_n > 1").drop("_n"), "digests")
    joined = lookup_join(rows, several, ["payload_digest"], "left", salt_on=["page_id", "url"])
    return joined.withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))).drop("first_id")


def utc_text(when: Column) -> Column:
    """A timestamp as ISO 8601 text in UTC, whatever the session's time zone is; fractions are cut."""
    seconds = F.unix_seconds(when)
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int"))
    of_day = F.pmod(seconds, F.lit(86_400))
    two = lambda n: F.lpad(F.floor(n).cast("string"), 2, "0")
    clock = F.concat_ws(":", two(of_day / 3600), two(F.pmod(of_day, F.lit(3600)) / 60), two(F.pmod(of_day, F.lit(60))))
    return F.when(when.isNotNull(), F.concat(day.cast("string"), F.lit("T"), clock, F.lit("Z")))


def record_text() -> Column:
    """A WARC record without its final line breaks."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(BREAK))).otherwise("")
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(BREAK * 2),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.coalesce(name(F.col("page_id")), F.lit("<urn:page:none>"))),
        line("WARC-Date", utc_text(F.col("captured"))),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Refers-To", name(F.col("refers_to"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(BREAK),
        block,
    )


def write_archives(pages: DataFrame, path: str, *, records_per_archive: int = RECORDS_PER_ARCHIVE) -> None:
    """Write one record per row of ``page_id, url, captured, html`` into archive files under ``path``."""
    records = with_revisits(pages).select(record_text().alias("value"))
    records.write.option("lineSep", BREAK * 2).option("maxRecordsPerFile", records_per_archive).text(path)


def parse_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Offset, length, header fields and block of each record of an archive."""
    at = 0
    while at < len(data):
        head_end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:head_end].decode().split(BREAK)
        if first != "WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}: {first[:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines)
        block = head_end + 4
        end = block + int(fields["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end at byte {end}")
        yield at, end + 4 - at, fields, data[block:end]
        at = end + 4


def _number(name: str | None) -> int | None:
    text = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return None if text in ("", "none") else int(text)


def read_archives(spark, path: str) -> DataFrame:
    """An index row per record; the rows of an archive are a run, sorted by URL key, timestamp and id.

    Payloads of responses are hashed again and must match their header.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = []
                for offset, length, fields, block in parse_records(data):
                    http, payload = block.split(b"\r\n\r\n", 1)
                    size = int(http.decode().rsplit("Content-Length: ", 1)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if fields["WARC-Type"] == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
                        raise ValueError(f"{archive}: the payload at byte {offset} does not match its header")
                    rows.append((
                        fields.get("WARC-Target-URI"), fields.get("WARC-Date", "1970-01-01T00:00:00Z"), _number(fields["WARC-Record-ID"]),
                        fields["WARC-Type"], _number(fields.get("WARC-Refers-To")), size, digest, archive, offset, length,
                    ))
                if not rows:
                    continue
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    names = ["url", "date", "page_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "archive", "record_offset", "record_length"]
    schema = "url string, date string, page_id bigint, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, archive string, record_offset bigint, record_length bigint"
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    parsed = files.mapInArrow(parse, schema).select(
        url_key(F.col("url")).alias("url_key"), F.to_timestamp("date").alias("captured"), *names[2:]
    )
    # An archive is a row of several megabytes, so few of them may share a batch while the runs are written.
    with batches_of(spark, 1):
        return stage(parsed.sortWithinPartitions("archive", "url_key", "captured", "page_id"), "runs")


class LoserTree:
    """Merge of k sorted runs. Inner nodes hold the losers of their matches, so that the next
    row needs one comparison per level, all along the path of the run that won last."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs, self.k = runs, max(1, len(runs))
        self.at = [0] * len(runs)
        self.heads = [run[0] if run else None for run in runs] or [None]
        self.losers = [-1] * self.k
        self.winner = self._build(1)

    def _before(self, a: int, b: int) -> bool:
        """Whether run ``a`` comes first; a run that has ended comes last."""
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        left, right = self._build(2 * node), self._build(2 * node + 1)
        winner, self.losers[node] = (left, right) if self._before(left, right) else (right, left)
        return winner

    def __iter__(self) -> Iterator[tuple]:
        while (row := self.heads[self.winner]) is not None:
            yield row
            run = self.winner
            self.at[run] += 1
            self.heads[run] = self.runs[run][self.at[run]] if self.at[run] < len(self.runs[run]) else None
            node = (run + self.k) // 2
            while node:
                if self._before(self.losers[node], run):
                    self.losers[node], run = run, self.losers[node]
                node //= 2
            self.winner = run


def merge_index(runs: DataFrame, *, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Index rows in global order; ``history_order`` rises along it."""
    ranges = max(1, -(-runs.count() // rows_per_range))
    order = ["url_key", "captured", "page_id"]
    dealt = runs.repartitionByRange(ranges, *order)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        columns = [table[c].to_pylist() for c in ("archive", *order)]
        open_runs: dict[str, list[list[tuple]]] = {}
        for i, (archive, key, when, page) in enumerate(zip(*columns, strict=True)):
            row = (key, when, page is not None, page or 0, archive, i)
            own = open_runs.setdefault(archive, [[]])
            # A run that arrives in several pieces goes on as a run for each.
            if own[-1] and own[-1][-1] > row:
                own.append([])
            own[-1].append(row)
        merged = [row[-1] for row in LoserTree([run for own in open_runs.values() for run in own])]
        yield from table.take(pa.array(merged)).to_batches()

    return dealt.mapInArrow(merge, runs.schema).withColumn("history_order", F.monotonically_increasing_id())


def capture_histories(pages: DataFrame) -> DataFrame:
    """Write archives of ``page_id, url, captured, html``, read them back and merge their index.

    The merged index is written as files whose row groups follow the global order, so a look-up
    of one URL key reads a few of them.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path)
    return stage(merge_index(read_archives(spark, path)), "capture-index")
