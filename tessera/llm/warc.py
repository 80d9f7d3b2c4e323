"""Web pages to WARC archives and back: sorted shards, files rolled by size, repeats as revisits."""

from __future__ import annotations

import uuid
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_path, frugal, scratch, table, text_of, written

#: Bytes of payload of a shard, shards at least, and compressed bytes after which a shard goes on in another file.
SHARD_BYTES, LEAST_SHARDS, ROLL_BYTES = 1 << 30, 64, 256 << 20
#: Rows that the bounds of the shards are found from, about: those whose hash is small.
SAMPLE = 20_000
#: The date of records, a setting, as archives have to come out the same each time.
DATE = "2000-01-01T00:00:00Z"
#: Fixed values of the WARC 1.1 format.
VERSION, PROFILE = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fields of this library beside the format's: a page's id, that of the page which it repeats, bytes of its payload.
PAGE, REPEATS, LENGTH = "X-Page-Id", "X-Refers-To-Page-Id", "X-Payload-Length"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
LAST = 2**63 - 1
#: What a manifest says of a file.
MANIFEST = "shard bigint, part bigint, file string, records bigint, bytes bigint, sha1 string"
RECORD = "page_id bigint, target_uri string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, refers_to_record string, payload binary, file string"


def base32_sha1(data: bytes) -> str:
    from base64 import b32encode
    from hashlib import sha1

    return b32encode(sha1(data).digest()).decode()


def record_id(page: int | None, url: str | None, digest: str, copy: int) -> str:
    """The same for the same page each time; copy numbers a page's rows with equal payloads."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page}:{url if page is None else ""}:{digest}:{copy}')}>"


def target_uri(url: str | None, page: int | None) -> str:
    """A url as a header can carry it: no spaces, line ends or other signs beyond ASCII."""
    return quote(url, safe="%/:?#[]@!$&'()*+,;=~-._", errors="surrogatepass") if url else f"urn:x-page:{page}"


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, copy: int = 0, date: str = DATE) -> bytes:
    """A WARC record: a response with the payload, or without one a revisit of the page refers_to."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    digest = base32_sha1(payload)
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page, url, digest, copy)), ("WARC-Date", date), ("WARC-Target-URI", target_uri(url, page))]
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, None, digest, 0)), (REPEATS, str(refers_to))]
    head += [("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("WARC-Payload-Digest", f"sha1:{digest}"), (LENGTH, str(len(payload)))]
    head += [(PAGE, str(page))] * (page is not None) + [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"%s\r\n%s\r\n\r\n%s\r\n\r\n" % (VERSION, "\r\n".join(f"{k}: {v}" for k, v in head).encode(), block)


def member(data: bytes) -> bytes:
    """A gzip member of its own, without a time, as each record of an archive is."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a compressed archive, one record at a time in memory."""
    z, out = zlib.decompressobj(31), []
    for chunk in chunks:
        while chunk:
            out.append(z.decompress(chunk))
            chunk = z.unused_data
            if z.eof:
                yield parsed(b"".join(out))
                z, out = zlib.decompressobj(31), []
    if out or z.unconsumed_tail:
        raise ValueError("an archive ends within a record")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, both digests tested."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(headers["Content-Length"])]
    if version.encode() != VERSION or rest[len(block) :] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"record {headers.get('WARC-Record-ID')} is damaged")
    if headers["WARC-Type"] == "response" and headers["WARC-Payload-Digest"] != f"sha1:{base32_sha1(block.partition(b'\r\n\r\n')[2])}":
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    return headers, block


def arrow_schema(columns: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in columns.split(", "))])


def file_system(path: str):
    """The store of a path (a mounted folder, or one that pyarrow reaches) and the path in it."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    return FileSystem.from_uri(path) if ":/" in path else (LocalFileSystem(), path)


def shard_bounds(keys: DataFrame, shard_bytes: int, least_shards: int, sample: int) -> list[tuple[int, int]]:
    """First (id, spread) of each shard but the first, for shards of about shard_bytes, least_shards of them at least.

    From about ``sample`` rows whose hash is small, so that equal tables get equal bounds. Only how rows are dealt
    depends on them.
    """
    rows, size = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    shards = max(least_shards, -(-size // shard_bytes))
    share = min(1.0, max(sample, 8 * shards) / max(rows, 1))
    place = F.pmod(F.xxhash64("id", "tie"), F.lit(2**31))
    got = sorted((r.id, r.spread, r.size + 1) for r in keys.where(place < int(share * 2**31)).select("id", "spread", "size").collect())
    total, seen, out = sum(r[2] for r in got), 0, {}
    for *key, size in got:
        if shard := seen * shards // total:
            out.setdefault(shard, tuple(key))
        seen += size
    return sorted({*out.values()})


def revisits(keys: DataFrame, least_bytes: int) -> DataFrame:
    """(id, tie, refers_to) of the pages whose payload a page with a smaller id has too. Null ids, as the largest, can
    refer, and are referred to by none."""
    same = keys.where(F.col("size") >= least_bytes)
    first = same.groupBy("key").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("refers_to") < LAST)).drop("n")
    return same.join(first, "key").where("id > refers_to").select("id", "spread", "tie", "refers_to")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, shard_bytes: int = SHARD_BYTES, least_shards: int = LEAST_SHARDS, roll_bytes: int = ROLL_BYTES, sample: int = SAMPLE, date: str = DATE) -> DataFrame:
    """Writes a record per page to compressed archives below ``path``, in the order of the ids; returns the manifest.

    Shards are ranges of ids of about shard_bytes; a shard goes on in a new file once one has roll_bytes, so files
    are ``shard-00000012-0003.warc.gz``. Headers and digests are made from the payload. Of pages with equal payloads of
    least_bytes or more the one with the smallest id is a response and the others revisit it.

    Equal pages, settings and dates give equal files to the byte: bounds come from the data, identities from ids, and
    no time is written. Tasks write under temporary names of their own, so a task that runs twice or dies leaves no
    archive; Spark commits the list of what the tasks that counted wrote; only those files get their names, and the
    manifest, written last, makes the archive complete. Readers go by the manifest. A path that has one is refused.

    Null payload counts as empty, a null url gets one from the id, and a null id counts as largest (such pages are
    ordered by their contents). Rows that are equal in all three are written each. An empty table gives no files and an
    empty manifest; other columns are ignored. Ids are whole numbers under 2**63 - 1.
    """
    spark = pages.sparkSession
    base = pages.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"), F.col(url_col).cast("string").alias("url"), text_of(F.col(payload_col)).alias("payload"))
    # the rows of an id stay in one shard, those without an id are spread by their contents
    base = base.withColumn("tie", F.xxhash64("url", "payload")).withColumn("spread", F.when(F.col("id") == LAST, F.col("tie")).otherwise(0))
    keys = written(base.select("id", "spread", "tie", F.octet_length("payload").cast("long").alias("size"), F.unhex(F.sha2("payload", 256)).alias("key")))
    bounds = shard_bounds(keys, shard_bytes, least_shards, sample)
    temporary = f"{path.rstrip('/')}/_temporary-{uuid.uuid4().hex}"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = [bisect_right(bounds, key) for key in zip(batch.column("id").to_pylist(), batch.column("spread").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), *batch.columns], ["shard", *batch.schema.names])

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import sha1

        done, store, folder = [], *file_system(temporary)
        shard = part = out = digest = size = n = name = at = None

        def close() -> None:
            if out is not None:
                out.close()
                done.append({"shard": shard, "part": part, "file": name, "records": n, "bytes": size, "sha1": digest.hexdigest(), "at": at})

        last, copies, refers = None, Counter(), None
        for batch in batches:
            for start in range(0, len(batch), 64):
                for r in batch.slice(start, 64).to_pylist():
                    key = r["shard"], r["id"], r["tie"]
                    if key != last:
                        if last is None or key[1] != last[1] or key[1] == LAST:
                            copies.clear()
                        last, refers = key, None
                    if r["payload"] is None:  # comes before the pages that it is of
                        refers = r["refers_to"]
                        continue
                    if r["shard"] != shard or size >= roll_bytes:
                        close()
                        shard, part = r["shard"], part + 1 if r["shard"] == shard else 0
                        name = f"shard-{shard:08d}-{part:04d}.warc.gz"
                        at = f"{folder}/{uuid.uuid4().hex}-{name}"
                        store.create_dir(folder)
                        out, digest, size, n = store.open_output_stream(at, compression=None), sha1(), 0, 0
                    payload = r["payload"].encode(errors="surrogatepass")
                    copy = copies[hash(payload)]
                    copies[hash(payload)] += 1
                    data = member(record(None if r["id"] == LAST else r["id"], r["url"], payload, refers, copy, date))
                    out.write(data)
                    digest.update(data)
                    size, n = size + len(data), n + 1
        close()
        yield pa.RecordBatch.from_pylist(done, arrow_schema(f"{MANIFEST}, at string"))

    if _exists(spark, f"{path}/manifest"):
        raise ValueError(f"{path} has an archive")
    # what a page refers to meets its payload by the sort, so payloads are shuffled once
    none = lambda kind: F.lit(None).cast(kind)
    both = base.select("id", "spread", "tie", "url", "payload", none("long").alias("refers_to")).unionByName(revisits(keys, least_bytes).select("id", "spread", "tie", none("string").alias("url"), none("string").alias("payload"), "refers_to"))
    columns = "shard bigint, id bigint, spread bigint, tie bigint, url string, payload string, refers_to bigint"
    dealt = both.mapInArrow(frugal(deal), columns).repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", "id", "tie", F.col("payload").isNotNull())
    committed = written(dealt.mapInArrow(frugal(archive), f"{MANIFEST}, at string"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileType

        store, folder = file_system(path)
        for batch in batches:
            for file, at in zip(batch.column("file").to_pylist(), batch.column("at").to_pylist(), strict=True):
                if store.get_file_info(at).type != FileType.NotFound:
                    store.move(at, f"{folder}/{file}")
                elif store.get_file_info(f"{folder}/{file}").type == FileType.NotFound:  # else a lost task has named it
                    raise FileNotFoundError(at)
            yield batch

    manifest = f"{path.rstrip('/')}/manifest"
    committed.repartition("file").mapInArrow(name, f"{MANIFEST}, at string").drop("at").write.parquet(manifest)
    if _exists(spark, temporary):
        drop_path(spark, temporary)
    return manifest_of(spark, path)


def manifest_of(spark: SparkSession, path: str) -> DataFrame:
    """What the archive at path has: a row a file."""
    return spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives that the manifest of ``path`` lists, digests tested; page_id and refers_to are null
    where a record names no page. A file is read as a stream, so that a task holds one record."""
    schema = arrow_schema(RECORD)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_system(path)
        whole = lambda x: None if x is None else int(x)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{folder}/{file}", compression=None) as f:
                    for h, block in records(iter(lambda f=f: f.read(1 << 18), b"")):
                        payload = block.partition(b"\r\n\r\n")[2] if payloads and h["WARC-Type"] == "response" else None
                        rows.append(dict(zip(schema.names, (whole(h.get(PAGE)), h["WARC-Target-URI"], int(h[LENGTH]), h["WARC-Payload-Digest"].removeprefix("sha1:"), h["WARC-Type"], whole(h.get(REPEATS)), h["WARC-Record-ID"], h.get("WARC-Refers-To"), payload, file), strict=True)))
                        held += 500 + len(payload or b"")
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = manifest_of(spark, path).select("file")
    return files.repartition(max(1, files.count()), "file").mapInArrow(frugal(read), RECORD)


def op12_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = {
    "op12_warc_archives": """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t)::BIGINT AS payload_bytes, sha1(t) AS h, min(page_id) OVER (PARTITION BY t) AS first FROM p)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d
""",
}
QUERIES = {"op12_warc_archives": op12_warc_archives}
