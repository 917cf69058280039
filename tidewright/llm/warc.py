"""Content-addressed WARC archive.

An archive is two tables below one folder. `payloads`: each distinct payload
once, under its SHA-256, checked when stored and when read. `headers`: the exact
header bytes of every record, with the digest of its payload. A join on the
digest gives the records back byte by byte; revisits carry headers alone.

Joins deal a digest of many records by several keys: headers by salts where it has
a large share of all, payloads by lots of records.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, cut, lake_fs, map_arrow, table

#: Payloads below so many bytes are never made revisits.
LEAST_REVISIT = 100
#: Records that one copy of a payload answers for in the join; a payload of more is copied once for each such lot.
LOT = 512
#: A digest of a SHARE-th of all records or more (there are SHARE of them at most) is dealt by that many salts.
SHARE = 1024
#: What ends a record.
CLOSE = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def _head(kind: Column, id_: Column, url: Column, digest: Column, size: Column, refers: Column) -> Column:
    """The header block of a record, to the empty line; line ends in a URL are escaped."""
    url = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), "\r", "%0D"), "\n", "%0A")
    name = lambda x: F.format_string("<urn:page:%s>", F.coalesce(x.cast("string"), F.lit("null")))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    revisit = kind == "revisit"
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", name(id_)), line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)), line("X-Payload-Length", size.cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name(refers)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.when(revisit, F.lit("0")).otherwise(size.cast("string"))), F.lit("\r\n"),
    )


def write_archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> None:
    """Writes the two tables. A null payload is empty; an empty table makes an empty archive.

    Of records with equal payloads of LEAST_REVISIT bytes and more, those of the
    smallest id are responses (a null id comes last) and others revisit it;
    repeated rows are records of their own. Copies meet after a first merge in
    each task, so no task gets a group of copies whole.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(payload_col), F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    # A second hash tells a digest that two payloads share from one payload.
    check = rows.withColumn("other", F.xxhash64("payload"))
    kept = check.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("id").alias("first_id"), F.count("*").alias("n"), F.min("other").alias("low"), F.max("other").alias("high"), F.min("size").alias("size"), F.max("size").alias("most"))
    kept.select(F.when((F.col("low") == F.col("high")) & (F.col("size") == F.col("most")), F.col("digest")).otherwise(F.raise_error(F.lit("two payloads have one digest"))).alias("digest"), "size", "first_id", "n", "payload").write.parquet(f"{folder}/payloads")
    index = spark.read.parquet(f"{folder}/payloads").select("digest", "first_id", "n")
    total = index.agg(F.sum("n")).first()[0] or 0
    hot = index.select("digest", "first_id", "n", (F.col("n") >= max(LOT, total // SHARE)).alias("hot"))
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SHARE - 1))).otherwise(F.array(F.lit(0)))
    many = F.broadcast(hot.where("hot").select("digest", "hot"))  # SHARE rows at most
    rows = rows.drop("payload").join(many, "digest", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id", "url"), F.lit(SHARE)).cast("int")).otherwise(F.lit(0))).drop("hot")
    rows = rows.join(hot.select("digest", "first_id", "n", F.explode(salts).alias("salt")), ["digest", "salt"])
    kind = F.when((F.col("size") < LEAST_REVISIT) | F.col("id").eqNullSafe(F.col("first_id")), F.lit("response")).otherwise(F.lit("revisit"))
    rows = rows.withColumn("kind", kind)
    lots = F.ceil(F.col("n") / LOT)
    rows.select("id", "digest", F.encode(_head(F.col("kind"), F.col("id"), F.col("url"), F.col("digest"), F.col("size"), F.col("first_id")), "utf-8").alias("header"), F.pmod(F.xxhash64("id", "url"), lots).cast("int").alias("lot"), (F.col("kind") == "revisit").alias("revisit")).write.parquet(f"{folder}/headers")


def read_archive(spark, folder: str) -> DataFrame:
    """record (its exact bytes) and payload (that a revisit refers to; else null) of every record, by joining the two tables.

    A payload of many records is copied once for each LOT of them, and each lot
    is a key of its own, so no key holds more than about LOT records.
    """
    headers = spark.read.parquet(f"{folder}/headers").select("digest", "lot", "header", "revisit")
    stored = spark.read.parquet(f"{folder}/payloads").select("digest", "payload", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / LOT).cast("int") - 1)).alias("lot"))
    body = F.when(F.col("revisit"), F.lit(b"")).otherwise(F.col("payload"))
    return headers.join(stored, ["digest", "lot"]).select(F.concat("header", body, F.lit(CLOSE)).alias("record"), F.when(F.col("revisit"), F.col("payload")).alias("payload"))


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """The header fields and the body of one record's bytes."""
    head, close, rest = bytes(record).partition(CLOSE)
    said = parse_header(head + close)
    size = int(said["Content-Length"])
    if rest[size:] != CLOSE:
        raise ValueError(f"{said['WARC-Record-ID']} is not as long as its header says")
    return said, rest[:size]


def parse_header(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1" or lines[-2:] != ["", ""]:
        raise ValueError("no WARC header block")
    return dict(x.split(": ", 1) for x in lines[1:-2])


def records(archive: DataFrame) -> DataFrame:
    """What the records of read_archive() say, each payload checked against its header's digest and length."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string())])

    def number(name: str | None) -> int | None:
        value = name and name.removeprefix("<urn:page:").removesuffix(">")
        return None if value in (None, "null") else int(value)

    def parse(batches):
        for batch in batches:
            rows = []
            for record, payload in zip(batch.column(0), batch.column(1), strict=True):
                said, data = parse_record(record.as_buffer())
                if said["WARC-Type"] == "revisit":
                    data = memoryview(payload.as_buffer())
                digest = hashlib.sha256(data).hexdigest()
                if said["WARC-Payload-Digest"] != f"sha256:{digest}" or int(said["X-Payload-Length"]) != len(data):
                    raise ValueError(f"the payload of {said['WARC-Record-ID']} is not what its header says")
                rows.append((number(said["WARC-Record-ID"]), len(data), digest, said["WARC-Type"], number(said.get("WARC-Refers-To")), said["WARC-Target-URI"]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return map_arrow(archive, parse, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def export_files(archive: DataFrame, folder: str) -> DataFrame:
    """Writes the records as .warc files, one a partition, in the shared `folder`; returns path and n_records."""

    def write(batches):
        import uuid

        from pyspark import TaskContext

        fs, path = lake_fs(f"{folder}/part-{TaskContext.get().partitionId():06d}.warc")
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        draft, n = f"{path}.{uuid.uuid4().hex}", 0
        with fs.open_output_stream(draft) as out:
            for batch in batches:
                for record in batch.column(0):
                    out.write(record.as_buffer())
                    n += 1
        fs.move(draft, path)
        yield pa.RecordBatch.from_pylist([{"path": path, "n_records": n}])

    return map_arrow(archive.select("record"), write, "path string, n_records long")


def read_file(uri: str):
    """(header fields, body) of the records of one .warc file, read as a stream."""
    fs, path = lake_fs(uri)
    with fs.open_input_stream(path) as file:
        rest = b""
        while True:
            while b"\r\n\r\n" not in rest and (more := file.read(1 << 16)):
                rest += more
            if not rest:
                return
            head, _, rest = rest.partition(b"\r\n\r\n")
            said = parse_header(head + b"\r\n\r\n")
            need = int(said["Content-Length"]) + 4
            while len(rest) < need and (more := file.read(max(1 << 16, need - len(rest)))):
                rest += more
            if len(rest) < need:
                raise ValueError(f"{path} ends within a record")
            yield said, rest[: need - 4]
            rest = rest[need:]


def op4_content_addressed_warc(spark, sf_dir: str) -> DataFrame:
    """A row for each record of the archive of `pages`, parsed from its bytes. Null payloads are empty, a null id comes
    last, repeated rows are records of their own, an empty table gives no rows; payloads of any length are one record."""
    scratch = Scratch(spark, "warc")
    try:
        write_archive(table(spark, sf_dir, "pages"), scratch.path)
        return cut(records(read_archive(spark, scratch.path)).drop("url"))
    finally:
        scratch.drop()
