"""Publication of datasets that belong together: staged, then changed at once.

A run writes everything below a staging folder first. Only when all of it is
complete does it write a commit record that lists the moves, and makes them. A
run that fails before that leaves what was published as it was; one that dies in
between is finished by :func:`recover`, which every later run calls first: the
record names complete data, so it can always be rolled forward. Moves are
renames within one file system; readers see the old or the new dataset, and
between two renames a pair may be mixed for that moment.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

#: Spark's readers pass over names that begin with an underscore.
STAGING = "_staging-"
COMMIT = "_commit-"
#: The file in a published dataset that names the trial it holds.
OWNER = "_trial.json"


class Store:
    """The few file operations of a publication, on any Hadoop-compatible store. Failures are errors."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        found = self._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self._conf), found

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def names(self, path: str) -> list[str]:
        fs, at = self._at(path)
        return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        if fs.exists(at) and not fs.delete(at, True) and fs.exists(at):
            raise OSError(f"could not delete {path}")

    def move(self, source: str, target: str) -> None:
        fs, at = self._at(source)
        to = self._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(to.getParent())
        if not fs.rename(at, to):
            raise OSError(f"could not move {source} to {target}")

    def write(self, path: str, text: str) -> None:
        """All of ``text`` or no file: written beside and renamed."""
        fs, at = self._at(path + ".part")
        out = fs.create(at, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.move(path + ".part", path)

    def read(self, path: str) -> str | None:
        fs, at = self._at(path)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()


@dataclass
class Publication:
    """One run's datasets on their way to ``folder``."""

    spark: SparkSession
    folder: str
    key: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    moves: list[list[str]] = field(default_factory=list)
    drops: list[str] = field(default_factory=list)

    @property
    def staging(self) -> str:
        return f"{self.folder}/{STAGING}{self.key}"

    def stage(self, final: str) -> str:
        """Where to write the dataset that will be published as ``final``."""
        staged = f"{self.staging}/{len(self.moves)}"
        self.moves.append([staged, final])
        return staged

    def drop(self, final: str) -> None:
        """Remove ``final`` when the run is published."""
        self.drops.append(final)

    def commit(self) -> None:
        store = Store(self.spark)
        record = f"{self.folder}/{COMMIT}{self.key}.json"
        store.write(record, json.dumps({"staging": self.staging, "moves": self.moves, "drops": self.drops}))
        _finish(store, record)

    def abandon(self) -> None:
        """Remove what an uncommitted run has staged."""
        Store(self.spark).delete(self.staging)


def _finish(store: Store, record: str) -> None:
    """Make the moves of a commit record; those made before are passed over."""
    plan = json.loads(store.read(record) or "{}")
    for path in plan.get("drops", []):
        store.delete(path)
    for staged, final in plan.get("moves", []):
        if store.exists(staged):
            store.delete(final)
            store.move(staged, final)
    if plan.get("staging"):
        store.delete(plan["staging"])
    store.delete(record)


def recover(spark: SparkSession, folder: str) -> int:
    """Finish the publications below ``folder`` that were committed and not completed; how many there were."""
    store = Store(spark)
    records = sorted(n for n in store.names(folder) if n.startswith(COMMIT) and n.endswith(".json"))
    for name in records:
        _finish(store, f"{folder}/{name}")
    return len(records)


def check_owner(store: Store, path: str, trial_code: str) -> None:
    """Two codes may have one file name: a dataset of another trial is not replaced."""
    text = store.read(f"{path}/{OWNER}")
    owner = json.loads(text).get("trial_code") if text else None
    if owner is not None and owner != trial_code:
        raise FileExistsError(f"{path} holds trial {owner!r}, whose file name equals that of {trial_code!r}")


def write_owner(store: Store, path: str, trial_code: str) -> None:
    store.write(f"{path}/{OWNER}", json.dumps({"trial_code": trial_code}))
