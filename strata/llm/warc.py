"""WARC archives and their merged capture index.

Pages become WARC records (a response, or a revisit of an equal payload), written as archive files by
Spark's text writer, gzipped; offsets are those of the unpacked archive. Reading back parses each archive by its Content-Length fields and yields one run
of captures an archive, sorted by URL key, time and page. The runs are dealt out by ranges of that order
and each range merges its slices of the runs with a loser tree, so that ranges in turn are globally ordered.
"""

from __future__ import annotations

import gzip
import hashlib
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import scratch, table

REVISIT_BYTES = 1000
#: Size classes of payloads and how many records of each an archive holds: none is over 64 MB but for one huge page alone.
CLASSES = ((64 << 10, 1024), (1 << 20, 64), (1 << 62, 1))
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = "\r\n"


def decide(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, refers_to); refers_to is null for responses.

    Of equal payloads of ``least`` bytes or more the largest page_id is the response; every row with that id
    is one. Digests of payloads that occur once never leave the aggregate.
    """
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1(F.col("payload").cast("binary")).alias("payload_digest"))
    big = p.filter(F.col("payload_bytes") >= least).groupBy("payload_digest").agg(F.max("page_id").alias("latest"), F.count("*").alias("n"))
    big = big.filter("n > 1 and latest is not null").select(F.col("payload_digest").alias("d"), "latest")
    other = (F.col("payload_bytes") >= least) & F.col("latest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("latest"))
    return p.join(big, F.col("payload_digest") == F.col("d"), "left").withColumn("refers_to", F.when(other, F.col("latest"))).drop("d", "latest")


def _record(start: str):
    """One record as text, but for the last CRLF, which the writer's line end is."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "%", "%25"), "\r", "%0D"), "\n", "%0A")
    revisit = F.col("refers_to").isNotNull()
    date = F.date_format(F.timestamp_seconds(F.lit(start).cast("timestamp").cast("long") + F.coalesce(F.col("page_id"), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    return F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.coalesce(line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))), F.lit("")),
        F.coalesce(line("WARC-Target-URI", clean), F.lit("")), line("WARC-Date", date),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.coalesce(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))), F.lit("")),
        F.when(revisit, line("WARC-Profile", F.lit(PROFILE))).otherwise(F.lit("")),
        F.lit("Content-Type: text/html" + CRLF), line("Content-Length", F.octet_length(body).cast("string")), F.lit(CRLF), body, F.lit(CRLF))


def write(pages: DataFrame, path: str, start: str = "2024-01-01 00:00:00") -> list[str]:
    """Write the records under ``path``, a folder for each size class of payloads that occurs; the folders. Pages carry
    no time: the capture time is ``start`` plus the page_id in seconds. A null html is an empty payload, null page_ids
    and urls leave their header out, repeated rows are records of their own, other columns are not read, and an
    empty table has no folders."""
    own = F.coalesce(F.octet_length("html"), F.lit(0))
    kind = sum((F.when(own > top, 1).otherwise(0) for top, _ in CLASSES[:-1]), F.lit(0))
    there = {r[0] for r in pages.select(kind.alias("k")).distinct().collect()}  # one row a class
    out, low = [], -1
    for k, (top, per_file) in enumerate(CLASSES):
        if k in there:
            # equal payloads have one size and so one class: each page takes part in one class's join alone
            folder = f"{path}/class={k}"
            decide(pages.filter((own > low) & (own <= top))).select(_record(start).alias("value")).write.option(
                "lineSep", CRLF).option("maxRecordsPerFile", per_file).option("compression", "gzip").text(folder)
            out.append(folder)
        low = top
    return out


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, lower-case, without scheme and www, then path and query."""
    if not url:
        return ""
    try:
        u = urlsplit(url if "//" in url else f"//{url}")
        host = (u.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    return f"{','.join(reversed(host.split('.')))}){u.path or '/'}{'?' + u.query if u.query else ''}".lower()


def parse(raw: bytes):
    """(headers, payload, offset, length) of each record of an archive."""
    at = 0
    while at < len(raw):
        head = raw.index(b"\r\n\r\n", at)
        fields = dict(x.split(": ", 1) for x in raw[at:head].decode().split("\r\n")[1:])
        begin = head + 4
        end = begin + int(fields["Content-Length"])
        if raw[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"no record end at {end}")
        yield fields, raw[begin:end], at, end + 4 - at
        at = end + 4


CAPTURE = pa.schema([("url_key", pa.string()), ("ts", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
_CAPTURE = "url_key string, ts string, page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, archive string, offset long, length long"
_order = lambda r: (r[0], r[1], r[2] is not None, r[2] or 0, r[8], r[9])


def _read(batches):
    """One sorted run of captures an archive. A response's digest and length are taken of its bytes and must agree with its header."""
    number = lambda x: int(x[len("<urn:page:"):-1]) if x else None
    for b in batches:
        for i in range(b.num_rows):
            run = []
            for f, payload, at, n in parse(gzip.decompress(b.column(1)[i].as_py())):
                digest, size = f["WARC-Payload-Digest"].removeprefix("sha1:"), int(f["X-Payload-Length"])
                if f["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, size):
                    raise ValueError(f"payload of {f.get('WARC-Record-ID')} does not agree with its header")
                url = f.get("WARC-Target-URI")
                url = url and url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
                run.append((url_key(url), "".join(c for c in f["WARC-Date"] if c.isdigit()), number(f.get("WARC-Record-ID")), url, f["WARC-Type"], number(f.get("WARC-Refers-To")), digest, size, b.column(0)[i].as_py(), at, n))
            run.sort(key=_order)
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*run), CAPTURE)], schema=CAPTURE) if run else pa.RecordBatch.from_pylist([], schema=CAPTURE)


def loser_tree(runs: list[list]):
    """Merge sorted runs of (key, row): inner nodes keep the losers, the winner goes out and its run's next item climbs one path."""
    k, done = len(runs), object()
    heads = [iter(r) for r in runs]
    item = [next(h, done) for h in heads]
    beats = lambda a, b: item[b] is done or (item[a] is not done and (item[a][0], a) < (item[b][0], b))
    tree, winner = [-1] * max(k, 1), 0
    for leaf in range(k):
        w, node = leaf, (leaf + k) // 2
        while node > 0:
            if tree[node] < 0:  # the first to come waits here for the other side
                tree[node], w = w, -1
                break
            if beats(tree[node], w):
                tree[node], w = w, tree[node]
            node //= 2
        if w >= 0:
            winner = w
    while k and item[winner] is not done:
        yield item[winner][1]
        item[winner] = next(heads[winner], done)
        w, node = winner, (winner + k) // 2
        while node > 0:
            if beats(tree[node], w):
                tree[node], w = w, tree[node]
            node //= 2
        winner = w


def _merge(batches):
    rows, runs = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))], {}
    for r in rows:
        runs.setdefault(r[8], []).append((_order(r), r))
    out = []
    for r in loser_tree(list(runs.values())):
        out.append(r)
        if len(out) == 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), CAPTURE)], schema=CAPTURE)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), CAPTURE)], schema=CAPTURE)


def index(spark: SparkSession, folders: list[str]) -> DataFrame:
    """All captures of the archives in the folders, ordered by (url_key, ts, page_id) over the partitions in turn;
    repeated rows are captures of their own, and ties go by archive and offset."""
    if not folders:
        return spark.createDataFrame([], _CAPTURE)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folders).select("path", "content")
    captures = files.mapInArrow(_read, _CAPTURE)
    dealt = captures.repartitionByRange(F.col("url_key"), F.col("ts"), F.col("page_id")).sortWithinPartitions("archive", "url_key", "ts", "page_id", "offset")
    return dealt.mapInArrow(_merge, _CAPTURE)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index(spark, write(table(spark, sf_dir, "pages"), scratch(spark, "warc"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest AS d, max(page_id) AS latest FROM p WHERE payload_bytes >= 1000 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN latest IS NULL OR page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN latest IS NOT NULL AND page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM p LEFT JOIN g ON payload_digest = d
"""
