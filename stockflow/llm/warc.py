"""Operator 5: WARC archives, written by Spark's text writer and read by a Python data source.

Writing. A record is one string and the text writer's line separator is the
two line ends that close a record, so the files of the text writer are WARC
files. They are committed by Spark's own protocol, on any file system it knows.

Reading. The data source plans one partition for each file, takes equality
filters on the record type and on the columns that come from header fields,
parses a record's header first, and steps over a payload without decoding it if
the record is not wanted or payloads are not asked for.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

LEAST_SHARED = 100
_END = "\r\n"
# Header fields by column. The names that the standard gives.
_FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
    "page_id": "X-Page-ID",
    "payload_bytes": "X-Payload-Length",
}
SCHEMA = (
    "record_type string, record_id string, target_uri string, payload_digest string, refers_to string, "
    "page_id long, payload_bytes long, content_length long, payload string"
)


def records(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """One column ``value``: the WARC record of each row of ``pages``, without its closing line ends."""
    plain = pages.select(
        "page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.sha2("html", 256))
    shared = F.octet_length("html") >= least
    first = plain.filter(shared).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    # Unequal payloads are not looked up: only digests that occur more than once are joined.
    placed = plain.join(first.filter("n > 1").drop("n"), "digest", "left")
    revisit = F.coalesce(shared & (F.col("page_id") > F.col("first")), F.lit(False))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7F]", "")

    def field(name: str, value: Column) -> Column:
        """One header line, or nothing where the value is null."""
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(_END)), F.lit(""))

    def name_of(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))

    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    return placed.select(
        F.concat(
            F.lit(f"WARC/1.1{_END}"),
            field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
            field("WARC-Record-ID", name_of(F.col("page_id"))),
            field("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
            field("WARC-Target-URI", F.when(uri != "", uri)),
            field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            field("WARC-Refers-To", F.when(revisit, name_of(F.col("first")))),
            field("WARC-Profile", F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            field("X-Page-ID", F.col("page_id")),
            field("X-Payload-Length", F.octet_length("html")),
            field("Content-Type", F.lit("text/html; charset=utf-8")),
            field("Content-Length", F.octet_length(body)),
            F.lit(_END),
            body,
        ).alias("value")
    )


def write(pages: DataFrame, path: str, least: int = LEAST_SHARED) -> None:
    """Write ``pages`` as WARC files to the folder ``path``."""
    records(pages, least).write.option("lineSep", _END + _END).option("compression", "gzip").text(path)


class _File(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


def _open(path: str):
    """A binary stream; paths without a scheme and of scheme ``file`` are local, others go through Arrow."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return gzip.open(parts.path) if parts.path.endswith(".gz") else open(parts.path, "rb")
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    stream = io.BufferedReader(system.open_input_file(place))
    return gzip.open(stream) if place.endswith(".gz") else stream


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.files = json.loads(options["files"])
        self.decode = options.get("payload", "true") == "true"
        self.verify = options.get("verify", "false") == "true"
        self.wanted: dict[str, set] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, EqualTo) and column in _FIELDS:
                values = {f.value}
            elif isinstance(f, In) and column in _FIELDS:
                values = set(f.value)
            else:
                yield f
                continue
            self.wanted[column] = self.wanted.get(column, values) & values

    def partitions(self) -> list[InputPartition]:
        return [_File(path) for path in self.files]

    def read(self, partition: _File | None) -> Iterator[tuple]:
        if partition is None:  # a source without files still has one partition
            return
        with _open(partition.path) as stream:
            while (row := self._record(stream)) is not None:
                if row:
                    yield row

    def _record(self, stream) -> tuple | None:
        """The next record: None at the end of the file, () if it is not wanted."""
        line = stream.readline()
        if not line:
            return None
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin: {line[:40]!r}")
        header: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            key, _, value = line.decode("utf-8").partition(":")
            header[key.strip().lower()] = value.strip()
        length = int(header["content-length"])
        row = [self._value(c, header.get(name.lower())) for c, name in _FIELDS.items()]
        wanted = all(row[i] in self.wanted[c] for i, c in enumerate(_FIELDS) if c in self.wanted)
        if not wanted or not (self.decode or self.verify):
            stream.seek(length + 4, 1)
            return (*row, length, None) if wanted else ()
        payload = stream.read(length)
        if len(payload) < length or stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short or longer than its header says")
        if self.verify and row[0] == "response" and hashlib.sha256(payload).hexdigest() != row[3]:
            raise ValueError(f"payload of {row[1]} does not have its digest")
        return (*row, length, payload.decode("utf-8") if self.decode else None)

    @staticmethod
    def _value(column: str, text: str | None):
        if text is None or column not in ("page_id", "payload_bytes", "payload_digest"):
            return text
        return text.partition(":")[2] if column == "payload_digest" else int(text)


class WarcSource(DataSource):
    """Options: ``files``, a JSON list of paths; ``payload`` false leaves payloads out; ``verify`` checks digests."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def files(spark: SparkSession, path: str) -> list[str]:
    """Data files of a folder, by the file system the path belongs to."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in system.listStatus(folder) if s.isFile() and s.getLen() > 0]
    return sorted(p.toString() for p in found if not p.getName().startswith(("_", ".")))


def read(spark: SparkSession, path: str, payload: bool = True, verify: bool = False) -> DataFrame:
    """Records of the WARC files in the folder ``path``; an empty folder gives no row."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    options = {"files": json.dumps(files(spark, path)), "payload": str(payload).lower(), "verify": str(verify).lower()}
    return spark.read.format("warc").options(**options).load()


def round_trip(pages: DataFrame, path: str, least: int = LEAST_SHARED) -> DataFrame:
    """Write ``pages`` to ``path``, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Of rows with equal payloads of ``least`` bytes or more, that with the
    smallest page_id is the response and others revisit it; rows that repeat that
    page_id are responses as well. A null html is empty, a null url gives no
    URI. A row without page_id is a response and comes back without one. White
    space and control characters in a URL are left out. Other columns are
    ignored; an empty table gives no row. Digests of responses are checked
    against the payloads that are read.
    """
    write(pages, path, least)
    referred = F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1)
    return read(pages.sparkSession, path, payload=False, verify=True).select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.when(referred != "", referred.cast("long")).alias("refers_to"),
    )
