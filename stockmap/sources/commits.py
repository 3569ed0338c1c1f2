"""Atomic commits of a folder's state: immutable manifests and one pointer file.

``{folder}/_state/v=<version>-<id>.json`` describes one version of whatever the
folder holds; ``{folder}/_state/current`` names the manifest that counts. A
commit writes the manifest, then the pointer beside its place, then renames it
over the old one. Before that rename readers see the old version whole, after
it the new one; there is nothing between. Manifests without a pointer are what
a lost writer left and are removed with old versions.

The rename replaces its target in one step on HDFS, local and similar file
systems (``FileContext.rename`` with OVERWRITE). One writer at a time, as a
stream or a load job is: a commit on another version than the one it was made
from is refused, but two commits in the same instant are not told apart.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since this one read the state."""


@dataclass(frozen=True)
class State:
    """One version: its number (0 and an empty body before the first commit) and what its manifest says."""
    version: int
    body: dict


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _hadoop(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _read(spark: SparkSession, path: str) -> str | None:
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _swap(spark: SparkSession, new: str, place: str) -> None:
    """Rename ``new`` over ``place`` in one step."""
    sc = spark.sparkContext
    fs = sc._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    how = sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    source = fs.Path(new)
    fs.FileContext.getFileContext(source.toUri(), sc._jsc.hadoopConfiguration()).rename(source, fs.Path(place), how)


def _folder(folder: str) -> str:
    return f"{folder.rstrip('/')}/_state"


def current(spark: SparkSession, folder: str) -> State:
    """The committed state of ``folder``."""
    name = _read(spark, f"{_folder(folder)}/current")
    if name is None:
        return State(0, {})
    found = json.loads(_read(spark, f"{_folder(folder)}/{name}"))
    return State(found["version"], found["body"])


def commit(spark: SparkSession, folder: str, base: State, body: dict) -> State:
    """Make ``body`` the state of ``folder``, if ``base`` still is."""
    new = State(base.version + 1, body)
    name = f"v={new.version:012d}-{uuid.uuid4().hex[:10]}.json"
    _write(spark, f"{_folder(folder)}/{name}", json.dumps({"version": new.version, "body": body}))
    aside = f"{_folder(folder)}/next-{uuid.uuid4().hex[:10]}"
    _write(spark, aside, name)
    if current(spark, folder).version != base.version:
        raise ConcurrentCommit(f"{folder} has moved on from version {base.version}")
    _swap(spark, aside, f"{_folder(folder)}/current")
    return new


def kept(spark: SparkSession, folder: str, versions: int) -> list[State]:
    """The states of the last ``versions`` committed versions, newest first; older and lost manifests are removed.

    Call it from the writer, after a commit. Of several manifests of one
    version only the committed one counts: each state names the manifest
    before it, so the chain is followed from the pointer.
    """
    fs, p = _hadoop(spark, _folder(folder))
    names = {x.getPath().getName() for x in fs.listStatus(p)} if fs.exists(p) else set()
    newest = current(spark, folder)
    chain, used = [newest], {"current", _read(spark, f"{_folder(folder)}/current")}
    while len(chain) < versions and (before := chain[-1].body.get("before")) in names:
        found = json.loads(_read(spark, f"{_folder(folder)}/{before}"))
        chain.append(State(found["version"], found["body"]))
        used.add(before)
    for name in names - used:
        if not name.startswith("."):
            fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_folder(folder)}/{name}"), True)
    return chain


def manifest_name(spark: SparkSession, folder: str) -> str | None:
    """The name of the committed manifest, for a state's ``before``."""
    return _read(spark, f"{_folder(folder)}/current")
