"""A set of datasets that belong together, replaced in one step.

Every run writes its datasets into a folder of its own. Readers find the folder by the manifest, which is switched when
all of them are complete, so they see the set of one run, never a mix, and keep what they have opened.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from punctuality.sources import files
from punctuality.sources.sinks import write_parquet
from punctuality.sources.store import Store

#: What makes a dataset from those of the same run that were made before it.
Maker = Callable[[Mapping[str, DataFrame]], DataFrame]


class Publication:
    """The published runs below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.store = Store(spark, root)

    def publish(self, datasets: Mapping[str, Maker]) -> dict[str, int]:
        """Make all datasets in their order, then switch readers to them; returns the rows by dataset.

        A run that fails is never seen, and the next one takes another folder or writes over what was left.
        """
        seen = self.store.manifest()
        run, made, rows = f"run-{seen.version + 1:012d}", {}, {}
        for name, make in datasets.items():
            path = f"{self.store.root}/{run}/{name}"
            frame = make(made)
            rows[name] = write_parquet(frame, path)
            made[name] = self.store.spark.read.schema(frame.schema).parquet(path)
        self.store.commit(seen, [], {"run": run, "rows": json.dumps(rows)})
        return rows

    def rows(self) -> dict[str, int]:
        """Rows of each dataset of the run that is published; none before the first."""
        return json.loads(self.store.manifest().notes.get("rows", "{}"))

    def read(self) -> dict[str, DataFrame]:
        """All datasets of the run that is published, as of one look at the manifest."""
        notes = self.store.manifest().notes
        if "run" not in notes:
            raise FileNotFoundError(f"nothing is published at {self.store.root}")
        names = json.loads(notes["rows"])
        return {name: self.store.spark.read.parquet(f"{self.store.root}/{notes['run']}/{name}") for name in names}

    def clean(self, keep: int = 2) -> list[str]:
        """Remove the folders of all runs before the last ``keep``; returns their names."""
        runs = [name for name in files.listed(self.store.spark, self.store.root) if name.startswith("run-")]
        last = self.store.manifest().version
        old = [name for name in runs if int(name.removeprefix("run-")) <= last - keep]
        for name in old:
            files.remove(self.store.spark, f"{self.store.root}/{name}")
        return old
