"""Tables that are replaced whole or not at all (IN-03).

A table is a folder with one subfolder of data for each version and small manifests
that say which version counts.  A new version is written to a folder of its own, then a
manifest with the next number is created, which fails if another writer was there first.
Readers take the highest manifest that is whole (it ends with a digest of what it
says).  A job that dies, at any point, leaves the version before it readable; what it has
left behind is removed by `clean`.  Files are reached through Hadoop's file system
interface alone, so any store that Spark can read will do.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_versions"


class Conflict(RuntimeError):
    """Another writer has committed the version that this one was going to."""


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    facts: dict


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _sealed(body: str) -> str:
    return f"{body}\n{hashlib.sha256(body.encode()).hexdigest()}\n"


def _opened(text: str) -> dict | None:
    """What a manifest says; None if it is not whole."""
    body, _, seal = text.strip().rpartition("\n")
    return json.loads(body) if body and hashlib.sha256(body.encode()).hexdigest() == seal else None


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    fs, p, jvm = _fs(spark, path)
    stream = fs.open(p)
    try:
        return str(jvm.org.apache.commons.io.IOUtils.toString(stream, jvm.java.nio.charset.StandardCharsets.UTF_8))
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file; Conflict if it is there already."""
    fs, p, _ = _fs(spark, path)
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in str(e.java_exception):
            raise Conflict(path) from e
        raise
    stream.write(bytearray(text.encode()))
    stream.close()


def versions(spark: SparkSession, path: str) -> list[Version]:
    """All committed versions, the oldest first."""
    fs, p, _ = _fs(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(p):
        return []
    out = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        if name.endswith(".json") and (said := _opened(read_text(spark, status.getPath().toString()))):
            out.append(Version(int(name[:-5]), f"{path.rstrip('/')}/{said['data']}", said["facts"]))
    return sorted(out, key=lambda v: v.number)


def current(spark: SparkSession, path: str) -> Version | None:
    """The version that counts."""
    found = versions(spark, path)
    return found[-1] if found else None


def _next(spark: SparkSession, path: str) -> int:
    """The number after all manifests, torn ones included."""
    fs, p, _ = _fs(spark, f"{path.rstrip('/')}/{MANIFESTS}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return 1 + max([int(n[:-5]) for n in names if n.endswith(".json")], default=0)


def publish(spark: SparkSession, path: str, write: Callable[[str], dict | None]) -> Version:
    """Let ``write`` fill a new folder and make it the version that counts.

    ``write`` gets the folder and may return facts to be kept in the manifest; what it raises is raised, and
    nothing is published then.
    """
    path = path.rstrip("/")
    number = _next(spark, path)
    data = f"data-{number}-{uuid.uuid4().hex}"
    facts = write(f"{path}/{data}") or {}
    create_text(spark, f"{path}/{MANIFESTS}/{number}.json", _sealed(json.dumps({"data": data, "facts": facts}, sort_keys=True)))
    return Version(number, f"{path}/{data}", facts)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that was written as Parquet."""
    found = current(spark, path)
    if found is None:
        raise FileNotFoundError(f"no committed version at {path}")
    return spark.read.parquet(found.path)


def clean(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` versions, and what failed writers left behind; to be run when nobody writes."""
    fs, p, jvm = _fs(spark, path)
    found = versions(spark, path)
    stay = {v.path.rpartition("/")[2] for v in found[-keep:]}
    numbers = {v.number for v in found[-keep:]}
    gone = []
    for status in fs.listStatus(p):
        if status.getPath().getName().startswith("data-") and status.getPath().getName() not in stay:
            gone.append(status.getPath().getName())
            fs.delete(status.getPath(), True)
    for status in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFESTS}")):
        if int(status.getPath().getName()[:-5]) not in numbers:
            fs.delete(status.getPath(), False)
    return sorted(gone)
