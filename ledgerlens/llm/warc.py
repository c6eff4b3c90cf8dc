"""Web archives: pages written as WARC records, archives read back, captures in one global order.

``write_archives`` writes a record for each page into files of gzip members. Of records with equal
payloads of at least ``LEAST_BYTES`` the one with the largest page_id holds the payload; the others
are ``revisit`` records that name it. ``read_records`` parses archives and checks each payload
against its digest. ``local_runs`` sorts what a task has read into runs of bounded length;
``merged_index`` deals the runs into ranges of (URL key, time) and merges each range's pieces of
runs with a loser tree, which gives all captures in one order and each its number in the history of
its URL.

Spark's text writer writes the files (so they go to any file system that Spark reaches, and a
failed task leaves nothing behind): a row is a record's gzip member, the line separator the member
of the empty lines that end every record. Decompressed, a file is a plain WARC file.

Defined results. A null html is an empty payload, a null url an empty one, a null page_id stays
null; its record is at time 0, and it names no other. Rows that repeat the largest page_id of a
group are all responses; other equal payloads revisit it, also those without an id; a group without
any id holds responses only. Empty tables give empty archives and an empty index. Columns beyond
page_id, url and html are not looked at, whatever their names. Payloads are never cut.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared

#: Smaller payloads are written whole each time.
LEAST_BYTES = 1000
#: Second of page 0 where no time of capture is given; page n is captured n seconds later.
FIRST_SECOND = 1_704_067_200
#: Entries that a task sorts at once, and entries of a range that a task merges.
RUN_ROWS, RANGE_ROWS = 50_000, 100_000
#: Groups of more copies than this, and than this share of all rows, are joined apart: there are at
#: most LARGE_GROUPS of them.
LARGE_ROWS, LARGE_GROUPS = 10_000, 10_000
#: The gzip member of the two empty lines behind a record.
END = gzip.compress(b"\r\n\r\n", mtime=0)
#: Fixed values of the format.
VERSION, REVISIT_PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "url_key string, captured long, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, archive string, offset long, length long"
ORDER = ("url_key", "captured", "page_id", "archive", "offset")


def address(url: str) -> str:
    """The URL as a record holds it: white space and control characters as %XX."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def url_key(url: str) -> str:
    """Key under which captures of one address meet: no scheme, fragment, default port or leading
    www; the host in lower case (A-Z) with its labels reversed; arguments sorted."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url.split("#", 1)[0])
    host, tail = re.match(r"([^/?]*)(.*)", rest, re.S).groups()
    host = re.sub(r"[A-Z]", lambda m: m[0].lower(), host)
    host = re.sub(r"^www[0-9]*\.", "", re.sub(r":(80|443)$", "", host))
    path, mark, query = tail.partition("?")
    query = mark + "&".join(sorted(query.split("&"))) if query else ""
    return ",".join(reversed(host.split("."))) + ")" + (path or "/") + query


def with_targets(pages: DataFrame, captured: Column | None = None) -> DataFrame:
    """page_id, url, payload, captured, digest (SHA-1), and the page that a revisit refers to.

    Groups of copies are counted first. Those of very many rows, which are few, are joined by a
    broadcast; so no join has a key with more than a bounded part of the rows."""
    captured = F.lit(FIRST_SECOND) + F.col("page_id") if captured is None else captured
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"), F.coalesce(captured.cast("long"), F.lit(0)).alias("captured"))
    rows = rows.withColumn("content", F.when(F.octet_length("payload") >= LEAST_BYTES, F.sha2("payload", 256)))
    groups = rows.filter("content is not null").groupBy("content").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("target")).filter("n > 1 and target is not null")
    groups = shared.stored(groups, "warc-copies", narrow=True)
    found = groups.agg(F.count(F.lit(1)), F.sum("n")).first()
    bound = max(LARGE_ROWS, (found[1] or 0) // LARGE_GROUPS)
    part = groups.select("content", "target")
    few, most = part.filter(F.col("n") > bound), part.filter(F.col("n") <= bound)
    joined = rows.join(F.broadcast(few.withColumnRenamed("target", "t1")), "content", "left")
    joined = joined.join(shared.small(most.withColumnRenamed("target", "t2"), found[0]), "content", "left")
    target = F.coalesce("t1", "t2")
    refers = F.when(~F.col("page_id").eqNullSafe(target), target)
    return joined.select("page_id", "url", "payload", "captured", F.sha1("payload").alias("digest"), refers.alias("refers_to"))


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [VERSION, f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block


def _member(record: bytes) -> bytes:
    """The record as a gzip member in which the bytes of END do not occur."""
    for level in (6, 9, 1, 0):
        made = gzip.compress(record, level, mtime=0)
        if END not in made:
            return made
    raise ValueError("a record cannot be told from the end of one")


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def _written(batches: Iterator) -> Iterator:
    import pyarrow as pa

    at = 0
    for batch in batches:
        members = []
        if not at:
            info = "software: ledgerlens\r\nformat: WARC File Format 1.1\r\n".encode()
            members.append(_member(_record("warcinfo", [("WARC-Record-ID", "<urn:page:info>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], info)))
            at = len(members[0]) + len(END)
        for x in batch.to_pylist():
            revisit = x["refers_to"] is not None
            fields = [
                ("WARC-Record-ID", _name(x["page_id"])), ("WARC-Target-URI", address(x["url"])), ("WARC-Date", _iso(x["captured"])), ("WARC-Archive-Offset", str(at)),
                ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(x["digest"])).decode()), ("Content-Type", "application/http;msgtype=response"),
            ]
            if revisit:
                fields += [("WARC-Refers-To", _name(x["refers_to"])), ("WARC-Profile", REVISIT_PROFILE)]
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(x['payload'])}\r\n\r\n".encode()
            members.append(_member(_record("revisit" if revisit else "response", fields, http if revisit else http + x["payload"])))
            at += len(members[-1]) + len(END)
        yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], ["member"])


def _iso(second: int) -> str:
    return datetime.fromtimestamp(second, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def write_archives(pages: DataFrame, path: str, captured: Column | None = None) -> None:
    """Write the pages below ``path``: a file of records for each task, begun by a warcinfo record."""
    shared.prepare(pages.sparkSession)
    members = with_targets(pages, captured).coalesce(shared.parts_of(pages)).mapInArrow(_written, "member binary")
    members.select(F.col("member").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option("lineSep", END.decode("latin-1")).text(path)


def parsed(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and block of one record; a block whose length is not the
    one it states is an error."""
    record = zlib.decompress(member, 31)
    head, _, block = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    if len(block) != int(fields["content-length"]):
        raise ValueError(f"{fields['warc-record-id']}: {len(block)} bytes of {fields['content-length']}")
    return fields, block


def _entry(member: bytes, archive: str, payload: bool) -> dict | None:
    fields, block = parsed(member)
    if fields["warc-type"] not in ("response", "revisit"):
        return None
    http, _, body = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    if fields["warc-type"] == "response" and (len(body) != size or hashlib.sha1(body).hexdigest() != digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload is not the one of its digest")
    second = int(datetime.strptime(fields["warc-date"], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=UTC).timestamp())
    found = {
        "url_key": url_key(fields["warc-target-uri"]), "captured": second, "page_id": _page(fields["warc-record-id"]), "url": fields["warc-target-uri"], "payload_bytes": size, "payload_digest": digest,
        "record_type": fields["warc-type"], "refers_to": _page(fields.get("warc-refers-to")), "archive": archive, "offset": int(fields["warc-archive-offset"]), "length": len(member) + len(END),
    }
    return found | {"payload": body if fields["warc-type"] == "response" else None} if payload else found


def _key(x: dict) -> tuple:
    return x["url_key"].encode(), x["captured"], x["page_id"] is not None, x["page_id"] or 0, x["archive"], x["offset"]


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """member (bytes of a record's gzip member) and the name of its file."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", END.decode("latin-1")).text(path)
    return lines.select(F.col("value").cast("binary").alias("member"), F.element_at(F.split("_metadata.file_path", "/"), -1).alias("archive"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All captures of the archives with their payloads (null for revisits), in no order."""
    import pyarrow as pa

    shared.prepare(spark)

    def read(batches: Iterator) -> Iterator:
        for batch in batches:
            found = [x for m, a in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if (x := _entry(m, a, True))]
            yield pa.RecordBatch.from_pylist(found, _schema(payload=True))

    return read_members(spark, path).mapInArrow(read, INDEX + ", payload binary")


def _schema(payload: bool = False, more: tuple = ()):
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [(n, kinds[k]) for n, k in (x.split() for x in INDEX.split(", "))]
    return pa.schema([*fields, *([("payload", pa.binary())] if payload else []), *((n, pa.int64()) for n in more)])


def local_runs(spark: SparkSession, path: str, run_rows: int = RUN_ROWS) -> DataFrame:
    """Index entries of all captures; each task gives what it has read in sorted runs."""
    import pyarrow as pa

    shared.prepare(spark)

    def sort(batches: Iterator) -> Iterator:
        held: list[dict] = []

        def run() -> pa.RecordBatch:
            held.sort(key=_key)
            out = pa.RecordBatch.from_pylist(held, _schema())
            held.clear()
            return out

        for batch in batches:
            for member, archive in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if x := _entry(member, archive, False):
                    held.append(x)
                if len(held) >= run_rows:
                    yield run()
        if held:
            yield run()

    return read_members(spark, path).mapInArrow(sort, INDEX)


def merge_order(keys: list, starts: list[int]) -> list[int]:
    """Places of ``keys`` in sorted order, by a loser tree over its sorted pieces, which begin at
    ``starts``. Equal keys come in the order of their pieces."""
    k = len(starts)
    if k < 2:
        return list(range(len(keys)))
    at, ends = list(starts), [*starts[1:], len(keys)]

    def before(a: int, b: int) -> bool:
        if at[a] == ends[a] or at[b] == ends[b]:
            return at[b] == ends[b] and (at[a] < ends[a] or a < b)
        x, y = keys[at[a]], keys[at[b]]
        return x < y or (x == y and a < b)

    won, lost = [0] * k + list(range(k)), [0] * k
    for node in range(k - 1, 0, -1):
        a, b = won[2 * node], won[2 * node + 1]
        won[node], lost[node] = (a, b) if before(a, b) else (b, a)
    best, out = won[1], []
    while at[best] < ends[best]:
        out.append(at[best])
        at[best] += 1
        node = (k + best) // 2
        while node:
            if before(lost[node], best):
                lost[node], best = best, lost[node]
            node //= 2
    return out


def _merged(batches: Iterator) -> Iterator:
    """One range: its rows come in pieces of runs, each sorted; a piece ends where the key falls."""
    import pyarrow as pa
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    rows = pa.Table.from_batches(batches, _schema())
    keys = [_key(dict(zip(ORDER, x, strict=True))) for x in zip(*(rows.column(c).to_pylist() for c in ORDER), strict=True)]
    order = merge_order(keys, [i for i in range(len(keys)) if not i or keys[i] < keys[i - 1]])
    numbers, last = [], None
    for i in order:
        numbers.append(numbers[-1] + 1 if keys[i][0] == last else 1)
        last = keys[i][0]
    n = len(order)
    rows = rows.take(pa.array(order, pa.int64())).append_column("part", pa.array([part] * n, pa.int64()))
    rows = rows.append_column("at", pa.array(range(n), pa.int64())).append_column("number", pa.array(numbers, pa.int64()))
    yield from rows.combine_chunks().to_batches(shared.ARROW_ROWS)


def merged_index(runs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All entries with ``place`` in the order by URL key and time (ties: page, file, offset) and
    ``capture``, the number within the history of the URL key, from 1.

    Ranges are merged apart; a row for each range carries counts over its borders, so a URL whose
    history fills many ranges is numbered through."""
    runs = shared.stored(runs, "warc-runs")
    n = runs.count()
    parts = max(1, min(runs.sparkSession.sparkContext.defaultParallelism, n // 1000), -(-n // range_rows))
    schema = INDEX + ", part long, at long, number long"
    merged = shared.stored(runs.repartitionByRange(parts, *ORDER).mapInArrow(_merged, schema), "warc-index")
    shared.dropped(runs)
    ranges = merged.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min_by("url_key", "at").alias("first"), F.max_by("url_key", "at").alias("last"), F.max_by("number", "at").alias("n_last"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ask = ranges.select("part", F.col("first").alias("key"), F.lit(0).alias("tells"), F.lit(0).cast("long").alias("v"))
    tell = ranges.select("part", F.col("last").alias("key"), F.lit(1).alias("tells"), F.col("n_last").alias("v"))
    before = Window.partitionBy("key").orderBy("part", "tells").rowsBetween(Window.unboundedPreceding, -1)
    carried = ask.unionByName(tell).withColumn("carried", F.coalesce(F.sum("v").over(before), F.lit(0))).filter("tells = 0")
    borders = ranges.select("part", "base", "first").join(carried.select("part", "carried"), "part")
    out = merged.join(shared.small(borders, parts), "part")
    number = F.col("number") + F.when(F.col("url_key") == F.col("first"), F.col("carried")).otherwise(0)
    columns = [x.split()[0] for x in INDEX.split(", ")]
    return out.select(*columns, (F.col("base") + F.col("at")).alias("place"), number.alias("capture"))


def archived(pages: DataFrame, captured: Column | None = None) -> DataFrame:
    """Write the pages as archives in the shared folder, read them back, and give their index."""
    path = shared.shared_dir(pages.sparkSession, "warc")
    write_archives(pages, path, captured)
    return merged_index(local_runs(pages.sparkSession, path))
