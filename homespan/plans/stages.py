"""Stages that run side by side where nothing binds them, and a manifest by which a failed run goes on.

A stage is done when its tables are published; the manifest then names their versions and a mark made of everything the
stage read: settings, input files with size and time, and the marks of the stages before it. A later run may take over a
stage whose mark is the same, so only what failed or what changed is run again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from homespan.sources.files import current_path, read_text, replace_text
from homespan.sources.tables import Written
from homespan.sources.versions import published


@dataclass(frozen=True)
class Stage:
    """A finished stage's table: what was written, and the stored rows."""

    written: Written
    table: DataFrame


Tables = dict[str, Stage]


@dataclass(frozen=True)
class Step:
    """A part of a run: the steps it reads from, what else its result depends on, and how it runs, given all tables so far."""

    after: tuple[str, ...]
    inputs: object
    run: Callable[[Mapping[str, Stage]], Tables]


class Manifest:
    """Finished steps in a small file that is replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str, resume: bool):
        self.spark, self.path = spark, path
        text = read_text(spark, path) if resume else None
        self.steps = json.loads(text) if text else {}

    def tables(self, name: str, mark: str) -> Tables | None:
        """The step's tables if it finished with this mark and they are still the current versions."""
        told = self.steps.get(name)
        if told is None or told["mark"] != mark:
            return None
        found = {}
        for table, t in told["tables"].items():
            if current_path(self.spark, t["path"].rsplit("/", 1)[0]) != t["path"]:
                return None
            schema = T.StructType.fromJson(t["schema"])
            written = Written(t["path"], t["fmt"], t["rows"], schema, tuple(t["partition_by"]))
            found[table] = Stage(written, published(self.spark, written))
        return found

    def add(self, name: str, mark: str, tables: Tables) -> None:
        told = {
            table: {
                "path": s.written.path, "fmt": s.written.fmt, "rows": s.written.rows,
                "partition_by": list(s.written.partition_by), "schema": s.written.schema.jsonValue(),
            }
            for table, s in tables.items()
        }
        self.steps[name] = {"mark": mark, "tables": told}
        replace_text(self.spark, self.path, json.dumps(self.steps, indent=1))


def _mark(step: Step, marks: Mapping[str, str]) -> str:
    told = json.dumps([repr(step.inputs), [marks[a] for a in step.after]])
    return hashlib.sha256(told.encode()).hexdigest()


def run_steps(spark: SparkSession, steps: Mapping[str, Step], manifest: Manifest) -> Tables:
    """All tables of all steps. Each step runs in a thread and a scheduler pool of its own once those before it are done.

    When a step fails, steps that do not depend on it still finish and are noted; then the first error is raised.
    """

    def in_pool(name: str, step: Step) -> Tables:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return step.run(tables)

    tables: Tables = {}
    marks: dict[str, str] = {}
    errors: list[BaseException] = []
    left, running = dict(steps), {}
    with ThreadPoolExecutor(max(1, len(steps))) as threads:
        while left or running:
            for name in [n for n, s in left.items() if all(a in marks for a in s.after)]:
                step = left.pop(name)
                mark = _mark(step, {a: marks[a] for a in step.after})
                if (kept := manifest.tables(name, mark)) is not None:
                    tables |= kept
                    marks[name] = mark
                    break  # others may have become ready
                future: Future = threads.submit(inheritable_thread_target(spark)(in_pool), name, step)
                running[future] = (name, mark)
            else:
                if not running:
                    break  # what is left waits for a step that failed
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    name, mark = running.pop(future)
                    if (error := future.exception()) is not None:
                        errors.append(error)
                        continue
                    tables |= future.result()
                    marks[name] = mark
                    manifest.add(name, mark, future.result())
    if errors:
        raise errors[0]
    return tables
