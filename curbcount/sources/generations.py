"""Tables that grow by batches and are merged in levels, so that reading them opens a bounded number of folders.

A batch is a folder of its own, named by what counts it and its number, so a repeated batch replaces itself.
When enough batches lie there they are merged into one set of the first level, enough sets of a level into one of
the next. A manifest names the sets that count and up to which number every run's batches are in them; it
is a new small file for every merge, written after the data, and the last whole one is valid. So readers see
either the batches or the set they went into, never both or neither, wherever a writer stops.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from curbcount import schemas
from curbcount.session import remove
from curbcount.sources import files

RUN, EPOCH = "run", "epoch"
#: Folders of a level that are merged at once.
FAN = 16
#: Merges for which replaced folders stay, for readers that have just planned to open them.
GRACE = 2
#: Runs of one batch only: their number need not be remembered once the folder is gone.
ONCE = "once-"


@dataclass
class Manifest:
    """``sets``: path below the root and level. ``upto``: the last merged batch of every run. ``retired``: what
    the last merges replaced, newest first. ``facts``: small values of the table's owner."""

    version: int = 0
    sets: list[dict] = field(default_factory=list)
    upto: dict[str, int] = field(default_factory=dict)
    retired: list[list[str]] = field(default_factory=list)
    facts: dict[str, str] = field(default_factory=dict)


class Generations:
    """``merge`` makes one table of the united rows of several (sums of sums, say); ``schema`` is its layout."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType | list[str] | str, merge: Callable[[DataFrame], DataFrame], fan: int = FAN):
        self.spark, self.root, self.merge, self.fan = spark, root.rstrip("/"), merge, fan
        self.schema = schemas.resolve(schema)

    # ------------------------------------------------------------ manifest

    def manifest(self) -> Manifest:
        """The newest whole one. One that was not written to its end does not count."""
        for entry in reversed(files.listing(self.spark, f"{self.root}/manifest")):
            try:
                return Manifest(**json.loads(files.read(self.spark, entry.path)))
            except (ValueError, TypeError):
                continue
        return Manifest()

    def commit(self, manifest: Manifest) -> bool:
        """Make it the valid one; False if another writer has been faster."""
        names = [e.name for e in files.listing(self.spark, f"{self.root}/manifest")]
        # numbers of torn files are not used again
        taken = max((int(n.removesuffix(".json")) for n in names), default=0)
        valid = self.manifest().version
        if valid != manifest.version:
            return False
        manifest.version = taken + 1
        if not files.create(self.spark, f"{self.root}/manifest/{manifest.version:012d}.json", json.dumps(vars(manifest))):
            return False
        for name in names[: -GRACE or None]:
            remove(self.spark, f"{self.root}/manifest/{name}")
        return True

    def facts(self) -> dict[str, str]:
        return self.manifest().facts

    def note(self, **facts: str) -> None:
        """Commit small values with the table, such as the newest run time."""
        while True:
            manifest = self.manifest()
            if manifest.facts | facts == manifest.facts:
                return
            manifest.facts |= facts
            if self.commit(manifest):
                return

    # ------------------------------------------------------------ batches

    def folder(self, run: str, epoch: int) -> str:
        return f"{self.root}/batches/{RUN}={run or 'none'}/{EPOCH}={epoch:012d}"

    def add(self, rows: DataFrame, run: str = "", epoch: int | None = None) -> None:
        """One batch; the same batch of the same run replaces itself. Without a number it is a run of its own."""
        if epoch is None:
            run, epoch = f"{ONCE}{uuid.uuid4().hex}", 0
        rows.write.mode("overwrite").parquet(self.folder(run, epoch))

    def batch(self, run: str, epoch: int) -> DataFrame:
        """The rows of one batch that was just added."""
        return self.spark.read.schema(self.schema).parquet(self.folder(run, epoch))

    def has(self, run: str, epoch: int) -> bool:
        """The batch was written to its end, or has been merged."""
        merged = self.manifest().upto.get(run or "none", -1) >= epoch
        return merged or files.exists(self.spark, f"{self.folder(run, epoch)}/_SUCCESS")

    def _batches(self, manifest: Manifest) -> list[tuple[str, int, str, bool]]:
        """(run, epoch, path, merged) of the batch folders that are whole."""
        out = []
        for own in files.listing(self.spark, f"{self.root}/batches"):
            run = own.name.removeprefix(f"{RUN}=")
            for entry in files.listing(self.spark, own.path):
                epoch = int(entry.name.removeprefix(f"{EPOCH}="))
                merged = epoch <= manifest.upto.get(run, -1)
                if merged or files.exists(self.spark, f"{entry.path}/_SUCCESS"):
                    out.append((run, epoch, entry.path, merged))
        return out

    # ------------------------------------------------------------ reading

    def paths(self, but: tuple[str, int] | None = None) -> list[str]:
        """Folders that hold every row once: the sets and the batches that are in none. ``but`` leaves out one
        batch and those after it in the same run, for a writer that may be repeating it."""
        manifest = self.manifest()
        run, last = (but[0] or "none", but[1]) if but else ("", 0)
        loose = [p for r, e, p, merged in self._batches(manifest) if not merged and not (but and r == run and e >= last)]
        return [f"{self.root}/{s['path']}" for s in manifest.sets] + loose

    def read(self, but: tuple[str, int] | None = None) -> DataFrame:
        """All rows, not merged with each other."""
        paths = self.paths(but)
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    # ------------------------------------------------------------ merging

    def compact(self, before: tuple[str, int] | None = None) -> bool:
        """Merge what is due, ``fan`` or more folders of a level at a time; True if something was merged.

        ``before`` keeps the batch of a run that may be repeated, and later ones, out of the sets. Sets that a writer left
        without a manifest are removed.
        """
        manifest = self.manifest()
        run, last = (before[0] or "none", before[1]) if before else ("", 0)
        batches = self._batches(manifest)
        ready = [b for b in batches if not b[3] and not (before and b[0] == run and b[1] >= last)]
        waiting = {p for paths in manifest.retired for p in paths}
        # merged, but the writer stopped before it could say so
        retired = [b[2] for b in batches if b[3] and b[2] not in waiting]
        if len(ready) >= self.fan:
            self._set(manifest, [b[2] for b in ready], 1)
            for own, epoch, _, _ in ready:
                manifest.upto[own] = max(epoch, manifest.upto.get(own, -1))
            retired += [b[2] for b in ready]
        level = 1
        while any(s["level"] >= level for s in manifest.sets):
            same = [s for s in manifest.sets if s["level"] == level]
            if len(same) >= self.fan:
                manifest.sets = [s for s in manifest.sets if s["level"] != level]
                self._set(manifest, [f"{self.root}/{s['path']}" for s in same], level + 1)
                retired += [f"{self.root}/{s['path']}" for s in same]
            level += 1
        if not retired:
            return False
        here = {b[0] for b in batches}
        manifest.upto = {r: e for r, e in manifest.upto.items() if r in here or not r.startswith(ONCE)}
        gone = manifest.retired[GRACE - 1 :]
        manifest.retired = [sorted(set(retired)), *manifest.retired[: GRACE - 1]]
        if not self.commit(manifest):
            return False
        for path in {p for paths in gone for p in paths}:
            remove(self.spark, path)
        self._sweep(manifest)
        return True

    def _set(self, manifest: Manifest, paths: list[str], level: int) -> None:
        name = f"sets/{uuid.uuid4().hex}"
        merged = self.merge(self.spark.read.schema(self.schema).parquet(*paths))
        merged.hint("rebalance").write.parquet(f"{self.root}/{name}")
        manifest.sets.append({"path": name, "level": level})

    def _sweep(self, manifest: Manifest) -> None:
        known = {f"{self.root}/{s['path']}" for s in manifest.sets} | {p for paths in manifest.retired for p in paths}
        for entry in files.listing(self.spark, f"{self.root}/sets"):
            if f"{self.root}/sets/{entry.name}" not in known:
                remove(self.spark, entry.path)
        for own in files.listing(self.spark, f"{self.root}/batches"):
            if own.name.startswith(f"{RUN}={ONCE}") and not files.listing(self.spark, own.path):
                remove(self.spark, own.path)
