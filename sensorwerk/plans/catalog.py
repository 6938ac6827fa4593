"""Named sources and models (SRC-6, SNK-9): ``source(name)`` / ``ref(model)`` resolve to DataFrames; a
model is materialized as a temp view or a saved table.

A model's references are built before it, in the order in which they need each other. A saved table
carries a mark made of the model's version, the state of its sources and the marks of its references: a
table with the mark is read, one with another mark is stale and built again, and a table without one
is not this catalog's and never touched.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

MARK = "model.mark"


@dataclass
class Model:
    build: Callable[[Catalog], DataFrame]
    materialized: str
    version: str
    refs: tuple[str, ...]
    sources: tuple[str, ...]


def files_state(frame: DataFrame) -> str:
    """The files that a frame reads with sizes and times, as a digest."""
    spark, out = frame.sparkSession, []
    for name in sorted(frame.inputFiles()):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
        out.append((name, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(json.dumps(out).encode()).hexdigest()


class Catalog:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._sources: dict[str, tuple[Callable[[SparkSession], DataFrame], Callable[[DataFrame], str]]] = {}
        self._models: dict[str, Model] = {}
        self._marks: dict[str, str] = {}

    def add_source(self, name: str, loader: Callable[[SparkSession], DataFrame], state: Callable[[DataFrame], str] = files_state) -> None:
        """``state`` tells whether the source changed (by default from its files)."""
        self._sources[name] = loader, state

    def add_model(self, name: str, build: Callable[[Catalog], DataFrame], materialized: str = "view", version: str = "1",
                  refs: tuple[str, ...] = (), sources: tuple[str, ...] = ()) -> None:
        """``refs`` and ``sources``: the models and sources that ``build`` asks for; ``version`` changes with its logic."""
        if materialized not in ("view", "table"):
            raise ValueError("materialized must be 'view' or 'table'")
        self._models[name] = Model(build, materialized, version, tuple(refs), tuple(sources))

    def source(self, name: str) -> DataFrame:
        return self._sources[name][0](self.spark)

    def order(self, names: list[str] | None = None) -> list[str]:
        """The models (all by default) with everything they refer to, each after its references."""
        done: list[str] = []

        def visit(name: str, path: tuple[str, ...]) -> None:
            if name in path:
                raise ValueError(f"models refer to each other: {' -> '.join((*path, name))}")
            if name not in self._models:
                raise ValueError(f"no model {name}" + (f", which {path[-1]} refers to" if path else ""))
            if name not in done:
                for ref in self._models[name].refs:
                    visit(ref, (*path, name))
                done.append(name)

        for name in names or sorted(self._models):
            visit(name, ())
        return done

    def mark(self, name: str) -> str:
        """What the model is made of now."""
        model = self._models[name]
        parts = [name, model.version, model.materialized, *[self._sources[s][1](self.source(s)) for s in model.sources],
                 *[self.mark(r) for r in model.refs]]
        return hashlib.sha256("|".join(parts).encode()).hexdigest()

    def _held_mark(self, name: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        return next((r.value for r in rows if r.key == MARK), None)

    def is_fresh(self, name: str) -> bool:
        """Whether the materialized model was built from the present state of all that it is made of."""
        if self._models[name].materialized == "view":
            return self._marks.get(name) == self.mark(name) and self.spark.catalog.tableExists(name)
        return self.spark.catalog.tableExists(name) and self._held_mark(name) == self.mark(name)

    def ref(self, name: str) -> DataFrame:
        """The model's rows: read if fresh, built with what it refers to otherwise."""
        self.run([name])
        return self.spark.table(name)

    def materialize(self, name: str) -> DataFrame:
        """Builds the model itself, fresh or not."""
        model, mark = self._models[name], self.mark(name)
        if model.materialized == "view":
            model.build(self).createOrReplaceTempView(name)
            self._marks[name] = mark
            return self.spark.table(name)
        if self.spark.catalog.tableExists(name) and self._held_mark(name) is None:
            raise ValueError(f"table {name} was not made by a model")
        draft = f"{name}__next"
        self.spark.sql(f"DROP TABLE IF EXISTS {draft}")
        model.build(self).write.saveAsTable(draft)                   # the old table stays readable until here
        self.spark.sql(f"ALTER TABLE {draft} SET TBLPROPERTIES ('{MARK}' = '{mark}')")
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(f"ALTER TABLE {draft} RENAME TO {name}")
        return self.spark.table(name)

    def run(self, names: list[str] | None = None) -> list[str]:
        """Brings the models and all they refer to up to date, in order; returns those that were built."""
        built = []
        for name in self.order(names):
            if not self.is_fresh(name):
                self.materialize(name)
                built.append(name)
        return built
