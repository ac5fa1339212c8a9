"""Datasets that grow by parts, by date, under a manifest.

A part is a folder of one dataset, written by one batch or one merge, with a sub-folder for each date. Nothing that is
written counts until a new version of the manifest names it: the manifest is one small file, a row for each live
folder of part and date, and appears in one step. Readers take the last version and open the folders it names, so
they see all datasets of one commit or none, whatever is being written meanwhile. One writer at a time; a second one is refused at its commit.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from punctuality.sources import files

DATE = "service_date"
#: Folder that Spark gives to rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Part:
    """Rows of a dataset: the folder of one part and one date."""

    dataset: str
    name: str
    date: str | None
    rows: int

    @property
    def folder(self) -> str:
        return f"{self.dataset}/part={self.name}/{DATE}={self.date or NO_DATE}"


@dataclass(frozen=True)
class Manifest:
    """One version: the live folders, and notes of the writers (short texts by name)."""

    version: int
    parts: tuple[Part, ...]
    notes: dict[str, str]

    def of(self, dataset: str) -> list[Part]:
        return [part for part in self.parts if part.dataset == dataset]


class Store:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> list[int]:
        names = files.listed(self.spark, f"{self.root}/manifest")
        return sorted(int(name.removesuffix(".json")) for name in names if name[:1].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """The last version, or the given one. A store that nothing was committed to has version 0 and no part."""
        known = self._versions()
        version = version if version is not None else (known[-1] if known else 0)
        if version == 0:
            return Manifest(0, (), {})
        held = json.loads(files.read_small(self.spark, f"{self.root}/manifest/{version:012d}.json"))
        return Manifest(version, tuple(Part(**row) for row in held["parts"]), held["notes"])

    def commit(self, seen: Manifest, parts: Iterable[Part], notes: dict[str, str] | None = None) -> Manifest:
        """Make ``parts`` and ``notes`` the next version after the one the writer has ``seen``."""
        new = Manifest(seen.version + 1, tuple(parts), seen.notes if notes is None else notes)
        text = json.dumps({"parts": [asdict(part) for part in new.parts], "notes": new.notes})
        if not files.put_once(self.spark, f"{self.root}/manifest/{new.version:012d}.json", text):
            raise RuntimeError(f"another writer has committed version {new.version} of {self.root}")
        return new

    def write(self, dataset: str, name: str, rows: DataFrame, *sort: str, spread: bool = True) -> list[Part]:
        """Write a part, its rows rebalanced by date and sorted within files. It counts once it is committed.

        Without ``spread`` rows are written by the tasks that made them: for rows of one date that a shuffle has spread evenly.
        """
        path = f"{self.root}/{dataset}/part={name}"
        if spread:
            rows = rows.hint("rebalance", DATE)
        if sort:
            rows = rows.sortWithinPartitions(DATE, *sort)
        rows.write.mode("overwrite").partitionBy(DATE).parquet(path)
        counted = self.spark.read.schema(f"{DATE} string").parquet(path).groupBy(DATE).agg(F.count(F.lit(1)).alias("n"))
        return [Part(dataset, name, r[DATE], r.n) for r in counted.collect()]

    def read(self, dataset: str, layout: str | StructType, parts: Iterable[Part] | None = None) -> DataFrame:
        """Rows of the live parts of a dataset, or of the given ones, with their date. Files are not listed beyond these."""
        layout = StructType.fromDDL(layout) if isinstance(layout, str) else layout
        folders = [part.folder for part in (self.manifest().of(dataset) if parts is None else parts) if part.rows]
        if not folders:
            return self.spark.createDataFrame([], StructType([f for f in layout.fields if f.name != DATE]).add(DATE, "string"))
        reader = self.spark.read.schema(layout).option("basePath", f"{self.root}/{dataset}")
        found = reader.parquet(*[f"{self.root}/{folder}" for folder in folders])
        names = [name for name in layout.names if name != DATE]
        return found.select(*names, F.col(DATE).cast("string").alias(DATE))

    def merge(self, dataset: str, layout: str | StructType, merged: Callable[[DataFrame], DataFrame], most: int, *sort: str) -> list[str | None]:
        """Rewrite the dates that have more than ``most`` parts as one part; returns these dates.

        ``merged`` takes the rows of the parts, date included, and gives those that stand for all of them. Only
        the parts of these dates are read, in one job; readers see the old parts until the commit.
        """
        seen = self.manifest()
        by_date: dict[str | None, list[Part]] = {}
        for part in seen.of(dataset):
            by_date.setdefault(part.date, []).append(part)
        old = {part for parts in by_date.values() if len(parts) > most for part in parts}
        if not old:
            return []
        new = self.write(dataset, f"merged-{seen.version + 1:012d}", merged(self.read(dataset, layout, sorted(old, key=lambda p: p.folder))), *sort)
        self.commit(seen, [part for part in seen.parts if part not in old] + new)
        return sorted({part.date for part in old}, key=lambda date: (date is not None, date))

    def clean(self, keep: int = 1) -> int:
        """Remove the manifests before the last ``keep`` and every folder that none of the kept ones names; returns how many
        folders went. For a moment without writers: a batch in progress has folders that no manifest names yet."""
        known = self._versions()
        kept = [self.manifest(version) for version in known[-keep:]]
        live = {part.folder for manifest in kept for part in manifest.parts}
        gone = 0
        for dataset in files.listed(self.spark, self.root):
            for name in files.listed(self.spark, f"{self.root}/{dataset}"):
                if not name.startswith("part="):
                    continue
                inside = [f"{dataset}/{name}/{date}" for date in files.listed(self.spark, f"{self.root}/{dataset}/{name}") if date.startswith(DATE)]
                dead = [folder for folder in inside if folder not in live]
                for folder in [f"{dataset}/{name}"] if len(dead) == len(inside) else dead:
                    files.remove(self.spark, f"{self.root}/{folder}")
                gone += len(dead)
        for version in known[:-keep]:
            files.remove(self.spark, f"{self.root}/manifest/{version:012d}.json")
        return gone
