"""A log of runs: folders of tables that are added, merged by levels and switched by a manifest.

A run is written to a folder of its own, which nobody sees until a manifest names it. The
manifests are numbered; the last one is the state. Each is put there once and as a whole, so
a reader sees one state or the next, and of two writers with the same state one fails.

Runs are merged in levels: when `FANOUT` runs of a level have come together, they become one
of the next, so the number of runs grows as the logarithm of the number of batches and a row
is written anew once a level. Folders stay while one of the last `KEPT` manifests names
them, for readers under way; others, left by merges or by writers that broke off, are deleted.

A run knows the batches it holds. A batch that is there already is not added again, so a
replay counts once.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidegauge.sources import files

FANOUT = 8
KEPT = 3

Merge = Callable[[DataFrame], DataFrame]
Write = Callable[[DataFrame, str], None]


def write_plain(df: DataFrame, path: str) -> None:
    df.hint("rebalance").write.parquet(path)


@dataclass
class Table:
    """How a table of the log is stored: its schema as read, how runs are merged, how it is written."""

    schema: StructType
    merge: Merge
    write: Write = write_plain


@dataclass
class Run:
    folder: str
    level: int
    first: int
    last: int
    tables: list[str] = field(default_factory=list)


class RunLog:
    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, Table], fanout: int = FANOUT):
        self.spark, self.root, self.tables, self.fanout = spark, root.rstrip("/"), tables, fanout

    # --- the state ---

    def _versions(self) -> list[int]:
        return [int(name.removesuffix(".json")) for name in files.names(self.spark, f"{self.root}/manifest")]

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifest/{version:012d}.json"

    def _runs_of(self, version: int) -> list[Run]:
        text = self.spark.read.text(self._manifest(version), wholetext=True).first()[0]
        return [Run(**run) for run in json.loads(text)["runs"]]

    def state(self) -> tuple[int, list[Run]]:
        """The number of the last manifest and its runs; 0 and none at the start."""
        versions = self._versions()
        return (versions[-1], self._runs_of(versions[-1])) if versions else (0, [])

    def holds(self, batch: int) -> bool:
        return any(run.first <= batch <= run.last for run in self.state()[1])

    def read(self, table: str, runs: list[Run] | None = None) -> DataFrame:
        """All rows of a table in the given runs, those of the last manifest if there are none given."""
        runs = self.state()[1] if runs is None else runs
        schema = self.tables[table].schema
        read = self.spark.read.schema(schema).parquet
        # Each by itself, as every run has partitions of its own; there are few.
        parts = [read(f"{self.root}/runs/{run.folder}/{table}") for run in runs if table in run.tables]
        return functools.reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    # --- changes ---

    def begin(self, first: int, last: int | None = None, level: int = 0) -> Run:
        last = first if last is None else last
        return Run(f"{level}-{first:012d}-{last:012d}-{uuid.uuid4().hex[:8]}", level, first, last)

    def write(self, run: Run, table: str, df: DataFrame) -> DataFrame:
        """Write a table of a run that no manifest names yet, and read it back."""
        self.tables[table].write(df, f"{self.root}/runs/{run.folder}/{table}")
        run.tables.append(table)
        return self.read(table, [run])

    def commit(self, added: Run, merged: list[Run] = ()) -> None:
        """Name ``added`` in place of ``merged`` in the next manifest."""
        version, runs = self.state()
        gone = {run.folder for run in merged}
        if not gone <= {run.folder for run in runs}:
            raise RuntimeError(f"{self.root}: other runs than those of the last manifest were merged")
        left = [run for run in runs if run.folder not in gone] + [added]
        text = json.dumps({"runs": [asdict(run) for run in sorted(left, key=lambda r: r.first)]})
        if not files.put_if_absent(self.spark, self._manifest(version + 1), text):
            raise RuntimeError(f"{self.root} has another writer")

    def compact(self) -> None:
        """Merge levels that have grown full, the lowest first."""
        while True:
            levels: dict[int, list[Run]] = {}
            for run in self.state()[1]:
                levels.setdefault(run.level, []).append(run)
            full = min((level for level, runs in levels.items() if len(runs) >= self.fanout), default=None)
            if full is None:
                break
            old = levels[full]
            new = self.begin(min(r.first for r in old), max(r.last for r in old), full + 1)
            for name in {name for run in old for name in run.tables}:
                self.write(new, name, self.tables[name].merge(self.read(name, old)))
            self.commit(new, old)
        self.sweep()

    def sweep(self) -> None:
        """Delete manifests before the last `KEPT`, and folders that none of those names."""
        versions = self._versions()
        named = {run.folder for version in versions[-KEPT:] for run in self._runs_of(version)}
        for folder in set(files.names(self.spark, f"{self.root}/runs")) - named:
            files.delete(self.spark, f"{self.root}/runs/{folder}")
        for version in versions[:-KEPT]:
            files.delete(self.spark, self._manifest(version))
