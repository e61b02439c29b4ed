"""WARC archives: a writer, and a splittable reader. A reading task scans its byte range
for the gzip magic, validates candidate members by decoding their headers, and owns the
records that start inside the range."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_dir, open_store, staged

#: Bytes of an archive that one reading range covers.
RANGE = 16 << 20
#: Bytes read at a time, and bytes decompressed at a time.
CHUNK = 1 << 20
PIECE = 1 << 16
#: Repeated digests up to which their table is broadcast; beyond it a bitmap of so many bits
#: (32 MB) is, that most payloads seen once pass the join by.
BROADCAST_ROWS = 500_000
BITS = 1 << 28
#: A payload that more than one in HOT of all rows share is always broadcast (fewer than HOT).
HOT = 1000
#: Fixed bytes at the start of a gzip member.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
DATE = "1970-01-01T00:00:00Z"
RECORDS = "record_id string, record_type string, target_uri string, payload_digest string, payload_bytes long, refers_to string, http_status int, payload binary, path string, offset long"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(record_id: str, uri: str, digest: str, payload: bytes | None, size: int, refers_to: str | None) -> bytes:
    """One gzip member with one record: a response with its payload, or (``refers_to``
    given) a revisit that names the response instead."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = head + (payload if refers_to is None else b"")
    kind = "response" if refers_to is None else "revisit"
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {quote(uri, safe=';/?:@&=+$,#[]!()*%~' + chr(39))}", "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(block)}")
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n") + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def _writer(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        store, base = open_store(root)
        out, name, count, size = None, "", 0, 0
        for pdf in batches:
            for rid, uri, digest, payload, n, refers in pdf.itertuples(index=False):
                if out is None:
                    # a name of its own for each attempt: a lost or doubled task never overwrites
                    name = f"{base}/part-{os.urandom(12).hex()}.warc.gz"
                    out = store.open_output_stream(name, compression=None)
                refers = None if refers is None or refers != refers else refers
                m = member(rid, uri or "", digest, payload, int(n), refers)
                out.write(m)
                count, size = count + 1, size + len(m)
        if out is not None:
            out.close()
            yield pd.DataFrame({"path": [f"{root}/{name.rsplit('/', 1)[1]}"], "records": [count], "size": [size]})

    return run


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record for every row of ``pages`` into gzip archives under ``root``;
    (path, records, size) of the files that count. Files that a lost task left behind
    are not in it, and readers go by it.

    Payload: the html in UTF-8 (null: empty). Of records with equal payloads those
    with the largest id are responses (repeated rows of it all are), the others revisit
    it; a null id is smaller than any. A null url gives an empty target. An empty table
    gives no file. Other columns are ignored."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    p = pages.select(F.col(id_col).cast("string").alias("id"), F.col(id_col).alias("raw"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha"))
    keys = pages.select(F.col(id_col).alias("raw"), F.sha1(payload).alias("sha"))
    # only payloads that occur again: the others need no partner
    again = keys.groupBy("sha").agg(F.max("raw").alias("most"), F.count("*").alias("n")).where("n > 1")
    again = staged(again.select(F.col("sha").alias("rsha"), "most", "n"), "warc-digests")
    j = _referred(p, again)
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("null")))
    refers = F.when(F.col("rsha").isNotNull(), urn(F.col("most")))
    n = F.octet_length("payload").cast("long")
    rows = j.select(urn(F.col("id")).alias("record_id"), "url", base32(F.col("sha")).alias("digest"), F.when(refers.isNull(), F.col("payload")).alias("payload"), n.alias("n"), refers.alias("refers_to"))
    store, path = open_store(root)
    store.create_dir(path, recursive=True)
    return staged(rows.mapInPandas(_writer(root), "path string, records long, size long"), "warc-files")


def _referred(p: DataFrame, again: DataFrame) -> DataFrame:
    """Payload rows with ``rsha`` and ``most`` of the record that they revisit, if any. While the
    repeated digests are few they are broadcast and nothing is shuffled. Beyond that only
    rows whose digest may be repeated, by a broadcast bitmap, meet them in a join; digests
    of a great share of the rows are broadcast, so no join key is hot."""
    other = (F.col("sha") == F.col("rsha")) & ~F.col("raw").eqNullSafe(F.col("most"))
    repeated, copies = again.agg(F.count("*"), F.sum("n")).first()
    if repeated <= BROADCAST_ROWS:
        return p.join(F.broadcast(again.drop("n")), other, "left")
    hot = again.where(F.col("n") * HOT > copies).select(F.col("rsha").alias("hsha"), F.col("most").alias("hmost"))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    bits = again.select(place("rsha").alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    flagged = p.join(F.broadcast(hot), F.col("sha") == F.col("hsha"), "left").withColumn("at", place("sha"))
    flagged = flagged.join(F.broadcast(bits), F.bitmap_bucket_number("at") == F.col("bucket"), "left")
    bit = F.bitmap_bit_position("at")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    may = F.col("hsha").isNull() & F.coalesce(F.call_function("shiftright", byte, (bit % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    past = flagged.where(~may).withColumn("rsha", F.when(~F.col("raw").eqNullSafe(F.col("hmost")), F.col("hsha"))).withColumn("most", F.col("hmost"))
    meet = flagged.where(may).select(*p.columns).join(again.drop("n"), other, "left")
    return past.select(*meet.columns).unionByName(meet)


def base32(hex_digest) -> F.Column:
    """Base32 (RFC 4648) of a digest in hex whose bits divide by five."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = []
    for k in range(4):  # 40 bits, 8 letters each
        bits = F.conv(F.substring(hex_digest, 10 * k + 1, 10), 16, 10).cast("long")
        parts += [F.substring(F.lit(alphabet), F.shiftright(bits, 35 - 5 * i).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1)) for i in range(8)]
    return F.concat(*parts)


def _headers(data: bytes) -> dict[str, str] | None:
    """Headers of a record, if ``data`` starts as one does."""
    head, gap, _ = data.partition(b"\r\n\r\n")
    if not data.startswith(b"WARC/1.") or not gap:
        return None
    out = {}
    for line in head.split(b"\r\n")[1:]:
        k, colon, v = line.partition(b":")
        if not colon:
            return None
        out[k.decode("latin-1").strip().lower()] = v.decode("utf-8", "replace").strip()
    return out if "warc-type" in out and out.get("content-length", "").isdigit() else None


class _Reader:
    """Bytes of a file from a place on, read one after another and kept from the place in hand
    on: nothing is read twice. Up to ``end`` by ``CHUNK``, beyond it by ``PIECE``."""

    def __init__(self, f, size: int, start: int, end: int):
        self.f, self.size, self.at, self.end, self.buf = f, size, start, end, bytearray()

    def drop(self, at: int) -> None:
        """Nothing before a place is needed again."""
        del self.buf[: at - self.at]
        self.at = max(self.at, at)

    def fill(self) -> bool:
        """Read on; False at the end of the file."""
        pos = self.at + len(self.buf)
        n = min(CHUNK, self.end - pos) if pos < self.end else PIECE
        self.f.seek(pos)
        data = self.f.read(min(n, self.size - pos)) if pos < self.size else b""
        self.buf += data
        return bool(data)

    def find(self, start: int, end: int) -> int:
        """The first place from ``start`` and before ``end`` where the magic stands, or -1."""
        self.drop(start)
        while True:
            k = self.buf.find(MAGIC)
            if k >= 0:
                return self.at + k if self.at + k < end else -1
            self.drop(max(self.at, self.at + len(self.buf) - len(MAGIC) + 1))
            if self.at >= end or not self.fill():
                return -1

    def member(self, at: int) -> tuple[bytes, int] | None:
        """(content, end) of the gzip member at a place; None if none decodes, or its
        content does not start as a record does."""
        self.drop(at)
        z, out, pos, checked = zlib.decompressobj(31), [], 0, False
        try:
            while not z.eof:
                if pos >= len(self.buf) and not self.fill():
                    return None
                with memoryview(self.buf) as whole, whole[pos : pos + PIECE] as piece:
                    out.append(z.decompress(piece))
                    pos += len(piece) - len(z.unused_data)
                if not checked and (first := b"".join(out))[:7]:
                    if not b"WARC/1.".startswith(first[:7]) and not first.startswith(b"WARC/1."):
                        return None
                    checked, out = len(first) >= 7, [first]
        except zlib.error:
            return None
        return b"".join(out), at + pos


def scan(f, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of the records that start in [start, end)."""
    r, at = _Reader(f, size, start, end), start
    while 0 <= (at := r.find(at, end)) < end:
        got = r.member(at)
        head = _headers(got[0]) if got else None
        if head is None:
            at += 1  # the magic stood inside another member
            continue
        data, stop = got
        body = data.index(b"\r\n\r\n") + 4
        yield at, head, data[body : body + int(head["content-length"])]
        at = stop


def _range_reader(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    for pdf in batches:
        for path, size, start, end in pdf[["path", "size", "start", "end"]].itertuples(index=False):
            store, name = open_store(path)
            rows, held = [], 0
            with store.open_input_file(name) as f:
                for at, h, block in scan(f, int(size), int(start), int(end)):
                    http, gap, payload = block.partition(b"\r\n\r\n")
                    fields = dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:] if b": " in x)
                    digest = h.get("warc-payload-digest", "").removeprefix("sha1:")
                    revisit = h["warc-type"] == "revisit"
                    if not revisit and digest != base32_sha1(payload):
                        raise ValueError(f"{path} at {at}: the payload does not have its digest")
                    strip = lambda x: None if x is None else x.strip("<>")
                    rows.append((strip(h.get("warc-record-id")), h["warc-type"], unquote(h.get("warc-target-uri", "")), digest, int(fields.get(b"Content-Length", len(payload))), strip(h.get("warc-refers-to")), int(http.split(b" ", 2)[1]), None if revisit else payload, path, at))
                    held += len(payload)
                    if held > 8 * CHUNK:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names)


def read_archives(files: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """The records of archives, (path, size) rows: each byte range is read by a task of
    its own. Payloads of responses are held against their digests."""
    cut = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(range_bytes).cast("long")))
    ranges = files.select("path", "size", cut.alias("start")).withColumn("end", F.least(F.col("start") + range_bytes, F.col("size")))
    n = max(1, min(ranges.count(), 100_000))
    return ranges.repartition(n).mapInPandas(_range_reader, RECORDS)


def round_trip(pages: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """Records of ``pages``, written to the shared folder and read back."""
    spark = pages.sparkSession
    files = write_archives(pages, fresh_dir(spark, "warc"))
    return read_archives(files, range_bytes)
