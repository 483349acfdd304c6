"""WARC archives: writing, and reading back by boundary-chain verification.

Writing uses Spark's text writer (records end with two line breaks, which is the writer's line separator), so
archives go to any file system Spark knows.  Of records with equal payloads of at least 100 bytes the one with the
smallest id is a response and the others are revisits without a payload.

Reading splits the archives at line breaks before "WARC/" wherever they stand, also inside payloads (a header cannot hold
one).  Any version line (1.0, 1.1, ...) and folded header lines are read.  Every task emits, per *candidate* (an occurrence that is
followed by a well-formed header), its offset and the offset of its successor by the declared length.  Chains are followed inside each split; what leaves a split is a small jump table over which
pointer jumping runs from each file's start in a number of rounds that is logarithmic in the splits of a file.
Only candidates on a file's chain are records.  A payload that contains such a place was cut by
the split; its pieces are kept by the tasks (they know how far declared lengths reach) and are put together again.
A file that begins like an archive and whose chain does not reach its end raises an error, or is listed by ``broken_archives``.

Records carry a record id (a UUID by page, payload and type, so repeated rows share one), a date, and for revisits the id of the response.
Null html is an empty payload; null or repeated page ids and urls are written as they are (an absent field reads as null; blanks and
control characters of urls are percent-encoded, since a header field is one line);
a null id is never the one that others refer to unless the whole group has none.  An empty table gives an empty archive and an
empty result.  Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch, start, table, text_or_empty, written

VERSION = "WARC/1.0\r\n"
MARK = b"WARC/"
CUT = b"\r\n" + MARK
END = "\r\n\r\n"
REVISIT_BYTES = 100
BROADCAST_ROWS = 500_000
RECORDS_PER_FILE = 50_000

# Fixed value: the profile name of a revisit by digest.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


# ---------------------------------------------------------------- writing


def _record_id(kind: str, page: Column, digest: Column) -> Column:
    """A UUID as a function of what is archived, so that a task run again writes the same."""
    h = F.md5(F.concat_ws("/", F.lit(kind), F.coalesce(page.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "$1-$2-3$3-8$4-$5"), F.lit(">"))


def _one_line(url: Column) -> Column:
    odd = [*range(33), 127]
    return F.when(url.rlike("[\\x00-\\x20\\x7f]"), reduce(lambda c, b: F.replace(c, F.lit(chr(b)), F.lit(f"%{b:02X}")), odd, url)).otherwise(url)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str | None = None) -> DataFrame:
    """One record per row, as a string without its end; ``date`` as ``2024-01-31T00:00:00Z``, else the present one."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = text_or_empty(html_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    firsts = rows.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.count("*").alias("n"), F.min("page_id").alias("first")).where("n > 1")
    firsts = written(firsts.select(F.col("digest").alias("d"), "first"), "repeated")
    side = F.broadcast(firsts) if firsts.count() <= BROADCAST_ROWS else firsts  # 72 bytes a row; beyond it a shuffled join
    rows = rows.join(side, (F.col("digest") == F.col("d")) & (F.col("bytes") >= REVISIT_BYTES), "left")
    # of rows that repeat the smallest id, all are responses
    revisit = F.col("d").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    this = F.when(revisit, _record_id("revisit", F.col("page_id"), F.col("digest"))).otherwise(_record_id("response", F.col("page_id"), F.col("digest")))

    def field(name: str, value: Column) -> Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")

    header = F.concat(
        F.lit(VERSION), F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        field("WARC-Target-URI", _one_line(F.col("url"))), field("WARC-Record-ID", this), F.lit(f"WARC-Date: {date}\r\n"), field("X-Page-Id", F.col("page_id")), field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.lit("X-Payload-Length: "), F.col("bytes").cast("string"), F.lit("\r\n"),
        F.when(revisit, F.concat(
            field("WARC-Refers-To", _record_id("response", F.col("first"), F.col("digest"))), field("X-Refers-To-Page", F.col("first")), F.lit(f"WARC-Profile: {PROFILE}\r\n"))).otherwise(""),
        F.lit("Content-Type: text/html\r\nContent-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string"))
    return rows.select(F.concat(header, F.lit(END), F.when(revisit, "").otherwise(F.col("payload"))).alias("value"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", per_file: int = RECORDS_PER_FILE) -> None:
    records(pages, id_col, url_col, html_col).write.option("lineSep", END).option("maxRecordsPerFile", per_file).text(path)


# ---------------------------------------------------------------- reading: pieces and candidates


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The bytes after each cut (and before a file's first), in file order inside each split."""
    text = spark.read.option("lineSep", CUT.decode()).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece"))


def _header(piece: bytes) -> tuple[dict[str, str], int, int] | None:
    """Fields, header length with its end, and content length; nothing if it is no header.  Headers may be of any length.

    The piece begins behind the mark, with the version; a line that begins with a blank goes on with the field before.  Of a payload
    that begins with the mark, the cut took the header's last line break."""
    cut = piece.find(b"\r\n\r\n")
    if cut < 0 and piece.endswith(b"\r\n"):
        cut = len(piece) - 2
    if cut < 0 or not _NUMBERED.match(piece):
        return None
    fields: dict[str, str] = {}
    name = ""
    for line in piece[:cut].split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and name:
            fields[name] = f"{fields[name]} {line.decode('utf-8', 'replace').strip()}".strip()
            continue
        raw, sign, value = line.partition(b":")
        if not sign:
            return None
        name = raw.decode("utf-8", "replace").strip().lower()
        fields[name] = value.decode("utf-8", "replace").strip()
    n = fields.get("content-length", "")
    return (fields, cut + 4, int(n)) if n.isascii() and n.isdigit() and len(n) < 19 else None


_NUMBERED = re.compile(rb"[0-9]+\.[0-9]+[ \t]*\r\n")


def _ended(raw: bytes, at: int) -> bool:
    """Does a record's end stand there, the last line break of which may be the next cut's?"""
    return raw[at : at + len(END)] == END.encode() or raw[at:] == CUT[:2]


def _places(at: int, raw: bytes) -> tuple[int, bytes, int]:
    """Offset of the record that may begin with this piece (negative: none), its bytes behind the mark, and where the next piece is.

    ``at`` is where the piece is; a file's first piece holds the mark itself."""
    after = at + len(raw) + len(CUT)
    if at:
        return at - len(MARK), raw, after
    return (0, raw[len(MARK):], after) if raw.startswith(MARK) else (-1, raw, after)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split: bytes of its pieces, how far declared lengths reach from its beginning, and whether the file begins as an archive."""
    now, size, total, reach, begins = None, 0, 0, 0, False
    rows = []
    for b in batches:
        for file, block, whole, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), strict=True):
            raw = piece.as_buffer().to_pybytes()
            if (file, block) != now:
                if now:
                    rows.append((*now, size, total, reach, begins))
                now, size, total, reach, begins = (file, block), whole, 0, 0, block == 0 and raw.startswith(MARK)
            head = block == 0 and total == 0
            body = raw[len(MARK):] if head and begins else raw
            h = _header(body) if begins or not head else None
            if h:
                first = total + len(raw) - len(body)  # behind the mark
                end = first + h[1] + h[2] + len(END)
                if end > total + len(raw) + 2 and end <= whole:  # past this piece and the line break that the cut took
                    reach = max(reach, end)
            total += len(raw) + len(CUT)
    if now:
        rows.append((*now, size, total, reach, begins))
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[c] for r in rows], k) for c, k in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()))],
        ["file", "block", "size", "bytes", "reach", "begins"])


_CANDIDATE = ("no int, block long, offset long, next long, page_id long, uri string, kind string, refers_to long, length long, "
              "declared_digest string, payload_bytes long, record_id string, refers_to_record string, digest string, piece binary")


def _number(x: str | None) -> int | None:
    try:
        return int(x) if x is not None and len(x) < 20 else None
    except ValueError:
        return None


def _candidates(shared) -> Callable:
    """Every piece with its offset, if it is a candidate or lies where declared lengths reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _CANDIDATE.split(", ")]
        kinds = [pa.int32(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 3, pa.binary()]
        now, no, at, reach = None, 0, 0, 0
        for b in batches:
            rows = []
            for file, block, size, piece in zip(*(b.column(k).to_pylist() for k in range(3)), b.column(3), strict=True):
                if (file, block) != now:
                    now = (file, block)
                    no, at, reach = shared.value[now]
                offset, raw, at = _places(at, piece.as_buffer().to_pybytes())
                if offset < 0:
                    continue
                h = _header(raw)
                end = offset + len(MARK) + h[1] + h[2] + len(END) if h else -1
                inside = offset < reach
                if h and end <= size:
                    f, head, n = h
                    body = raw[head : head + n]
                    whole = _ended(raw, head + n)
                    reach = reach if whole else max(reach, end)
                    digest = f.get("warc-payload-digest", "")
                    rows.append((no, block, offset, end, _number(f.get("x-page-id")), f.get("warc-target-uri"), f.get("warc-type"),
                                 _number(f.get("x-refers-to-page")), n, digest.removeprefix("sha256:"), _number(f.get("x-payload-length")),
                                 f.get("warc-record-id"), f.get("warc-refers-to"),
                                 hashlib.sha256(body).hexdigest() if whole else None, raw if inside or not whole else None))
                elif inside:
                    rows.append((no, block, offset, *[None] * 11, raw))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names)

    return run


# ---------------------------------------------------------------- reading: chains


def _exits(pdf):
    """Where the chain from each candidate of a split leaves it (the candidates of one split, so bounded)."""
    pdf = pdf.sort_values("offset")
    offsets, nexts = pdf["offset"].to_numpy(), pdf["next"].to_numpy()
    out = dict(zip(offsets.tolist(), nexts.tolist(), strict=True))
    for o in offsets[::-1].tolist():
        out[o] = out.get(out[o], out[o])
    return pdf.assign(exit=[out[o] for o in offsets.tolist()])[["no", "block", "offset", "next", "exit"]]


def _follow(key, candidates, entries):
    import pandas as pd

    nexts = dict(zip(candidates["offset"].tolist(), candidates["next"].tolist(), strict=True))
    found = set()
    for o in entries["entry"].tolist():
        while o in nexts and o not in found:
            found.add(o)
            o = nexts[o]
    return pd.DataFrame({"no": [key[0]] * len(found), "offset": sorted(found)}).astype({"no": "int32", "offset": "int64"})


def _reached(candidates: DataFrame) -> DataFrame:
    """``(no, offset)`` of the candidates on the chain from each file's start.  Numbers pack to little, so joins are merges: a broadcast
    chosen by packed size would grow with the records."""
    links = candidates.where("next is not null").select("no", "block", "offset", "next").dropDuplicates(["no", "offset"])
    out = "no int, block long, offset long, next long, exit long"
    jumps = written(links.groupBy("no", "block").applyInPandas(_exits, out), "jumps")
    # nodes that a chain can enter a split by: the start, and what some chain leaves a split for
    gates = jumps.select("no", F.col("exit").alias("offset")).unionAll(jumps.select("no", F.lit(0).cast("long").alias("offset"))).distinct()
    step = written(jumps.select("no", "offset", "exit").join(gates.hint("merge"), ["no", "offset"]), "gates")
    reached = written(step.where("offset = 0").select("no", "offset"), "reached")
    n = reached.count()
    while n:
        reached = written(reached.unionAll(step.join(reached.hint("merge"), ["no", "offset"]).select("no", F.col("exit").alias("offset"))).distinct(), "reached")
        size = reached.count()
        if size == n:
            break
        n = size
        a, b = step.alias("a"), step.alias("b").hint("merge")  # each jump becomes two
        step = written(a.join(b, (F.col("a.no") == F.col("b.no")) & (F.col("a.exit") == F.col("b.offset")), "left").select(
            "a.no", "a.offset", F.coalesce("b.exit", "a.exit").alias("exit")), "gates")
    entries = jumps.join(reached.hint("merge"), ["no", "offset"]).select("no", "block", F.col("offset").alias("entry"))
    return links.groupBy("no", "block").cogroup(entries.groupBy("no", "block")).applyInPandas(_follow, "no int, offset long")


def _assemble(key: tuple, rows: pa.Table) -> pa.Table:
    """The payload of one record from its pieces (as long as that record)."""
    rows = rows.sort_by("offset")
    raw = CUT.join(p.as_py() for p in rows.column("piece"))
    _, head, n = _header(raw)
    body = raw[head : head + n]
    whole = _ended(raw, head + n)
    return pa.table({"no": pa.array([key[0].as_py()], pa.int32()), "offset": pa.array([key[1].as_py()], pa.int64()),
                     "put_together": pa.array([hashlib.sha256(body).hexdigest() if whole else None], pa.string())})


class BrokenArchive(ValueError):
    """Files that begin as archives and whose chain of records ends before they do."""


def _chains(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates, those on chains, and per file ``(no, file, size, begins, reached)``."""
    start(spark)
    pieces = _pieces(spark, path)
    splits = pieces.mapInArrow(_measure, "file string, block long, size long, bytes long, reach long, begins boolean").collect()
    places: dict[tuple[str, int], tuple[int, int, int]] = {}  # an entry for each split, as the scan's own plan has
    files: list[tuple[int, str, int, bool]] = []
    base, cover = 0, 0
    for r in sorted(splits, key=lambda r: (r["file"], r["block"])):
        if not files or r["file"] != files[-1][1]:
            files.append((len(files), r["file"], r["size"], r["block"] == 0 and r["begins"]))
            base, cover = 0, 0
        places[r["file"], r["block"]] = (files[-1][0], base, cover)
        cover = max(cover, base + r["reach"])
        base += r["bytes"]
    candidates = written(pieces.mapInArrow(_candidates(spark.sparkContext.broadcast(places)), _CANDIDATE), "candidates")
    chain = written(_reached(candidates), "chain")
    links = candidates.where("next is not null").select("no", "offset", "next")
    reached = links.join(chain.hint("merge"), ["no", "offset"]).groupBy("no").agg(F.max("next").alias("reached"))
    named = spark.createDataFrame(files, "no int, file string, size long, begins boolean")
    return candidates, chain, written(named.join(reached, "no", "left"), "files")


def _broken(files: DataFrame) -> DataFrame:
    return files.where("begins and coalesce(reached, 0) < size").select("file", "size", F.coalesce("reached", F.lit(0).cast("long")).alias("reached"))


def broken_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(file, size, reached)`` of files that begin as archives and cannot be read to their end, with how far they can."""
    return _broken(_chains(spark, path)[2])


def read_archives(spark: SparkSession, path: str, on_broken: str = "fail") -> DataFrame:
    """``(file, offset, page_id, uri, kind, refers_to, length, declared_digest, payload_bytes, record_id, refers_to_record, digest)`` of all records.

    ``digest`` is that of the bytes read.  A file that does not begin with a record's mark has none.  Of a file whose chain breaks, the
    records before the break are kept with ``on_broken="keep"``; else ``BrokenArchive`` is raised."""
    candidates, chain, files = _chains(spark, path)
    if on_broken == "fail":
        torn = _broken(files).orderBy("file").limit(5).collect()
        if torn:
            raise BrokenArchive("; ".join(f"{r.file}: readable to byte {r.reached} of {r.size}" for r in torn))
    found = candidates.join(chain.hint("merge"), ["no", "offset"]).where("next is not null").drop("piece", "block")
    # pieces of records that the split cut: each belongs to the last record that begins before it
    starts = chain.select("no", "offset", F.lit(True).alias("begins"))
    kept = candidates.where("piece is not null").select("no", "offset", "piece", "digest").join(starts.hint("merge"), ["no", "offset"], "left")
    owner = F.last(F.when(F.col("begins"), F.struct("offset", "digest")), ignorenulls=True).over(
        Window.partitionBy("no").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0))
    cut = kept.withColumn("owner", owner).where("owner.digest is null and owner is not null").select(
        "no", F.col("owner.offset").alias("record"), "offset", "piece")
    whole = cut.groupBy("no", "record").applyInArrow(_assemble, "no int, offset long, put_together string")
    found = found.join(whole.hint("merge"), ["no", "offset"], "left").withColumn("digest", F.coalesce("digest", "put_together"))
    return found.join(files.select("no", "file"), "no").select("file", *[c for c in found.columns if c not in ("no", "next", "put_together")])


def archived(pages: DataFrame) -> DataFrame:
    """The pages written to archives in the shared folder and read back."""
    start(pages.sparkSession)
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archived(table(spark, sf_dir, "pages"))
    response = F.col("kind") == "response"
    return found.select(
        "page_id", F.when(response, F.col("length")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to")


OP8_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
     f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""
