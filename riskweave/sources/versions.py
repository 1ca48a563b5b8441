"""All-or-nothing refresh: versions of a set of datasets, and a pointer to the current one.

A run writes its datasets into a folder of its own and then commits it: a
small file ``_commits/<number>`` that names the folder appears by a rename
within the file system, which succeeds whole or not at all and never replaces
an existing file.  Readers take the commit of the highest number.  A run that
dies leaves a folder that no commit names; two runs that commit at once cannot
both take a number, and the second one fails without touching the first.

Old versions stay readable until ``vacuum`` removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from riskweave.session import remove

COMMITS = "_commits"


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    facts: dict


class Conflict(RuntimeError):
    """Another run has committed since this one began."""


def _store(spark: SparkSession, path: str) -> tuple[Any, Any]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _store(spark, path)
    source = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def commits(spark: SparkSession, root: str) -> list[Version]:
    """All committed versions, oldest first; one small file each."""
    folder = f"{root.rstrip('/')}/{COMMITS}"
    fs, p = _store(spark, folder)
    if not fs.exists(p):
        return []
    numbers = sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit())
    out = []
    for n in numbers:
        said = json.loads(_read(spark, f"{folder}/{n:08d}"))
        out.append(Version(n, f"{root.rstrip('/')}/{said['folder']}", said["facts"]))
    return out


def current(spark: SparkSession, root: str) -> Version:
    """The version that readers see."""
    folder = f"{root.rstrip('/')}/{COMMITS}"
    fs, p = _store(spark, folder)
    numbers = [int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()] \
        if fs.exists(p) else []
    if not numbers:
        raise FileNotFoundError(f"{root} has no committed version")
    said = json.loads(_read(spark, f"{folder}/{max(numbers):08d}"))
    return Version(max(numbers), f"{root.rstrip('/')}/{said['folder']}", said["facts"])


def resolve(spark: SparkSession, root: str) -> str:
    """Folder to read: the current version's, or ``root`` itself where nothing
    was ever committed there."""
    fs, p = _store(spark, f"{root.rstrip('/')}/{COMMITS}")
    return current(spark, root).path if fs.exists(p) else root


def refresh(spark: SparkSession, root: str, write: Callable[[str], dict | None]) -> Version:
    """Run ``write(folder)`` and commit the folder.

    What ``write`` returns is kept with the commit (counts, times).  If it
    raises, nothing is committed, its folder is removed and the error goes on;
    if the driver dies, the folder stays, unseen by readers, until ``vacuum``.
    """
    root = root.rstrip("/")
    seen = commits(spark, root)
    number = seen[-1].number + 1 if seen else 1
    name = f"version-{number:08d}-{uuid.uuid4().hex[:12]}"
    try:
        facts = write(f"{root}/{name}") or {}
    except BaseException:
        remove(spark, f"{root}/{name}")
        raise
    _commit(spark, root, number, name, facts)
    return Version(number, f"{root}/{name}", facts)


def _commit(spark: SparkSession, root: str, number: int, name: str, facts: dict) -> None:
    fs, folder = _store(spark, f"{root}/{COMMITS}")
    fs.mkdirs(folder)
    _, draft = _store(spark, f"{root}/{COMMITS}/.{name}")
    _, final = _store(spark, f"{root}/{COMMITS}/{number:08d}")
    out = fs.create(draft, True)
    out.write(json.dumps({"folder": name, "facts": facts}).encode())
    out.close()
    jvm = spark._jvm
    try:
        # FileContext renames fail where the target exists; FileSystem's may replace it
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
        context.rename(draft, final, spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(final):
            raise Conflict(f"version {number} of {root} was committed by another run") from e
        raise


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the versions before the last ``keep``, and folders of runs that
    never committed.  Not while a run is writing."""
    if keep < 1:
        raise ValueError("the current version must stay")
    root = root.rstrip("/")
    kept = commits(spark, root)[-keep:]
    names = {v.path.rsplit("/", 1)[1] for v in kept}
    fs, p = _store(spark, root)
    gone = sorted(n for s in fs.listStatus(p)
                  if (n := s.getPath().getName()).startswith("version-") and n not in names)
    if not kept:
        gone = []  # nothing is committed: a first run may be writing
    for v in commits(spark, root)[:-keep]:
        fs.delete(_store(spark, f"{root}/{COMMITS}/{v.number:08d}")[1], False)
    for n in gone:
        remove(spark, f"{root}/{n}")
    return gone
