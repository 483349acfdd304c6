"""Snapshots of a folder: what is live is what the newest generation file lists, and one rename publishes it.

``<path>/commit=<id>/`` holds the files of a commit, written before anyone reads them.  ``<path>/_generations/<n>`` lists the
live commits (and what else belongs to the state).  ``publish`` renames a prepared record to the next number, which
fails if that number exists: of writers that began from one generation only one gets through, and a reader sees the old or the new list,
never a mixture.  Commits that a newer generation left out stay for one more generation, for readers under way.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

GENERATIONS = "_generations"
PREPARED = "_commit-"


class ConcurrentCommit(RuntimeError):
    """Another writer published the generation that this one was about to."""


@dataclass(frozen=True)
class Snapshot:
    """Generation ``number`` (0: nothing published): live ``commits``, the ``tails`` (under-full files, which need not be live), and ``state``."""

    number: int = 0
    commits: tuple[str, ...] = ()
    tails: tuple[str, ...] = ()
    state: dict = field(default_factory=dict)

    def next(self, add: list[str], tails: list[str], drop: list[str], state: dict | None = None) -> Snapshot:
        commits = tuple(c for c in self.commits if c not in drop) + tuple(add)
        return replace(self, number=self.number + 1, commits=commits, tails=tuple(tails), state=self.state if state is None else state)


# ---------------------------------------------------------------- files


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _fs(spark, path)
    return spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(fs.open(at)).decode()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file; False if the target exists."""
    jvm = spark.sparkContext._jvm
    _, a = _fs(spark, source)
    fs, b = _fs(spark, target)
    fs.mkdirs(b.getParent())
    a, b = fs.makeQualified(a), fs.makeQualified(b)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b, how)
    except Exception as e:  # noqa: BLE001 - py4j wraps what the file system throws
        if "FileAlreadyExists" in str(e):
            return False
        raise
    return True


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, a = _fs(spark, source)
    _, b = _fs(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


# ---------------------------------------------------------------- generations


def new_commit(snapshot: Snapshot) -> str:
    """A folder name that tells from which generation its writer began."""
    return f"g{snapshot.number:09d}-{uuid.uuid4().hex[:12]}"


def latest(spark: SparkSession, path: str) -> Snapshot:
    found = names(spark, f"{path}/{GENERATIONS}")
    return _read(spark, f"{path}/{GENERATIONS}/{found[-1]}") if found else Snapshot()


def _read(spark: SparkSession, file: str) -> Snapshot:
    x = json.loads(read_text(spark, file))
    return Snapshot(x["number"], tuple(x["commits"]), tuple(x["tails"]), x["state"])


def prepare(spark: SparkSession, path: str, snapshot: Snapshot) -> str:
    """Write the record of a generation that is not published yet; returns its name."""
    name = f"{PREPARED}{snapshot.number:09d}-{uuid.uuid4().hex[:12]}"
    x = {"number": snapshot.number, "commits": list(snapshot.commits), "tails": list(snapshot.tails), "state": snapshot.state}
    write_text(spark, f"{path}/{name}.part", json.dumps(x))
    move(spark, f"{path}/{name}.part", f"{path}/{name}")
    return name


def publish(spark: SparkSession, path: str, record: str) -> Snapshot:
    """Make a prepared record the newest generation, or raise ``ConcurrentCommit`` and drop it."""
    snapshot = _read(spark, f"{path}/{record}")
    number = snapshot.number
    if latest(spark, path).number != number - 1 or not rename_new(spark, f"{path}/{record}", f"{path}/{GENERATIONS}/{number:09d}"):
        delete(spark, f"{path}/{record}")
        raise ConcurrentCommit(f"{path}: generation {number} was published by another writer")
    expire(spark, path)
    return snapshot


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete commits that none of the last ``keep`` generations lists and whose writers can publish no more, older generation
    files, and records that came too late."""
    found = names(spark, f"{path}/{GENERATIONS}")
    if not found:
        return
    kept = [_read(spark, f"{path}/{GENERATIONS}/{n}") for n in found[-keep:]]
    live = {c for s in kept for c in (*s.commits, *s.tails)}
    newest = kept[-1].number
    for name in names(spark, path):
        if name.startswith("commit=") and name[len("commit="):] not in live and int(name[len("commit=g"):].split("-")[0]) < newest - 1:
            delete(spark, f"{path}/{name}")
        if name.startswith(PREPARED) and int(name[len(PREPARED):].split("-")[0]) <= newest:
            delete(spark, f"{path}/{name}")
    for n in found[:-keep]:
        delete(spark, f"{path}/{GENERATIONS}/{n}")


def read(spark: SparkSession, path: str, commits: tuple[str, ...] | None = None) -> DataFrame | None:
    """Rows of the newest generation (or of some of its commits) with the union schema; None if it has none."""
    commits = latest(spark, path).commits if commits is None else commits
    if not commits:
        return None
    reader = spark.read.option("mergeSchema", "true").option("basePath", path)
    return reader.parquet(*[f"{path}/commit={c}" for c in commits]).drop("commit")
