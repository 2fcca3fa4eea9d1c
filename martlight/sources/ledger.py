"""Loads that count once: rows staged beside a table, checked, and moved in under a load id.

Every load leaves a record below ``<path>/_ledger/<table>/<load id>``: ``moving`` holds the partitions
a load is about to replace, ``loaded`` says that all of them are in place. A load that dies before
``moving`` has touched nothing but its own staging folder. One that dies later has put what it
replaced aside, and the next load or look at the table puts that back. A load that is
``loaded`` is not loaded again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.operators.quality import NOT_NULL
from martlight.schemas import TABLES
from martlight.session import hadoop_path
from martlight.sources.warehouse import Warehouse, write_files

LOADS = "load_id string, table_name string, state string, partitions array<string>, row_count bigint"


class LoadRejected(ValueError):
    """Staged rows broke a check; the table is as it was."""


@dataclass(frozen=True)
class LoadRecord:
    load_id: str
    table_name: str
    state: str
    partitions: list[str]
    row_count: int


def source_id(spark: SparkSession, *locations: str) -> str:
    """An id of the files below ``locations``: equal for the same names, sizes and times of writing."""
    listed = []
    for location in locations:
        path, files = hadoop_path(spark, location)
        for status in files.globStatus(path) or []:
            found = files.listFiles(status.getPath(), True)
            while found.hasNext():
                file = found.next()
                name = file.getPath().toString()
                if not file.getPath().getName().startswith(("_", ".")):
                    listed.append(f"{name} {file.getLen()} {file.getModificationTime()}")
    if not listed:
        raise FileNotFoundError(f"no files in {', '.join(locations)}")
    return hashlib.sha256("\n".join(sorted(listed)).encode()).hexdigest()[:32]


class LoadLedger:
    """The loads of the tables below one folder. One writer at a time; any number of readers.

    Only names of folders pass through the driver: a folder is moved by a rename, whatever it holds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- files -----------------------------------------------------------------

    def _at(self, *parts: str):
        """A location as a path; names of folders are taken as they are."""
        path, files = hadoop_path(self.spark, self.path)
        make = self.spark._jvm.org.apache.hadoop.fs.Path
        for part in filter(None, parts):
            # A child with a colon in its name parses as a scheme unless it is marked as relative.
            for name in part.split("/"):
                path = make(path, f"./{name}")
        return path, files

    def _note(self, record: LoadRecord) -> None:
        """Write a record in one step: a file that is there is whole."""
        final, files = self._at("_ledger", record.table_name, record.load_id, record.state)
        draft, _ = self._at("_ledger", record.table_name, record.load_id, f"_{record.state}")
        out = files.create(draft, True)
        out.write(bytearray(json.dumps(asdict(record)).encode()))
        out.close()
        if not files.rename(draft, final):
            raise OSError(f"cannot write {final.toString()}")

    def _noted(self, name: str, load_id: str, state: str) -> LoadRecord | None:
        path, files = self._at("_ledger", name, load_id, state)
        if not files.exists(path):
            return None
        found = files.open(path)
        try:
            return LoadRecord(**json.loads(bytes(found.readAllBytes()).decode()))
        finally:
            found.close()

    def _children(self, *parts: str) -> list[str]:
        path, files = self._at(*parts)
        if not files.exists(path):
            return []
        return sorted(s.getPath().getName() for s in files.listStatus(path) if s.isDirectory())

    def _move(self, source: tuple, target: tuple) -> None:
        files = source[1]
        files.mkdirs(target[0].getParent())
        if not files.rename(source[0], target[0]):
            raise OSError(f"cannot move {source[0].toString()} to {target[0].toString()}")

    # --- loads -----------------------------------------------------------------

    def _staged_partitions(self, name: str, load_id: str) -> list[str]:
        """Folders of partitions as Spark has named them, or "" for a table without partitions."""
        folders = [""]
        for _ in TABLES[name].partition_by:
            folders = [
                "/".join(filter(None, (f, c))) for f in folders for c in self._children("_staging", name, load_id, name, f)
            ]
        return folders

    def recover(self, name: str) -> list[str]:
        """Undo the loads of a table that died while they moved, and remove what others left staged."""
        undone = []
        for load_id in self._children("_ledger", name):
            moving = self._noted(name, load_id, "moving")
            if moving is not None and self._noted(name, load_id, "loaded") is None:
                for partition in moving.partitions:
                    self._put_back(name, load_id, partition)
                path, files = self._at("_ledger", name, load_id)
                files.delete(path, True)
                undone.append(load_id)
        for area in ("_staging", "_replaced"):
            path, files = self._at(area, name)
            if files.exists(path):
                files.delete(path, True)
        return undone

    def _put_back(self, name: str, load_id: str, partition: str) -> None:
        """Undo one partition's move, however far it or an earlier undoing got."""
        staged, place, aside = self._places(name, load_id, partition)
        files = place[1]
        if not files.exists(staged[0]) and files.exists(place[0]):
            # The staged rows were moved in: they go first.
            self._move(place, staged)
        if files.exists(aside[0]):
            self._move(aside, place)

    def _places(self, name: str, load_id: str, partition: str) -> tuple:
        return (
            self._at("_staging", name, load_id, name, partition),
            self._at(name, partition),
            self._at("_replaced", name, load_id, partition or "all"),
        )

    def load(
        self,
        rows: DataFrame,
        name: str,
        load_id: str,
        expected_rows: int | None = None,
        moved: Callable[[str], None] | None = None,
    ) -> LoadRecord:
        """Replace the partitions that ``rows`` has (all rows of a table without partitions); once per id.

        Rows are written to a staging folder, read back and checked: their number against
        ``expected_rows``, and no null in a column declared NOT NULL. ``LoadRejected`` leaves the table as it
        was. ``moved`` is told each partition that is in place. An id that is loaded changes nothing and
        gives back its record.
        """
        done = self._noted(name, load_id, "loaded")
        if done is not None:
            return done
        self.recover(name)
        staging = f"{self.path}/_staging/{name}/{load_id}"
        write_files(rows, name, staging)
        staged = Warehouse(self.spark, path=staging).table(name)
        required = NOT_NULL.get(name, [])
        counted = staged.agg(
            F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required]
        ).first()
        broken = [f"{counted[c]} nulls in {c}" for c in required if counted[c]]
        if expected_rows is not None and counted["rows"] != expected_rows:
            broken.append(f"{counted['rows']} rows, {expected_rows} expected")
        if broken:
            self.recover(name)
            raise LoadRejected(f"load {load_id} of {name}: {'; '.join(broken)}")
        partitions = self._staged_partitions(name, load_id)
        self._note(LoadRecord(load_id, name, "moving", partitions, counted["rows"]))
        for partition in partitions:
            staged_at, place, aside = self._places(name, load_id, partition)
            if place[1].exists(place[0]):
                self._move(place, aside)
            self._move(staged_at, place)
            if moved is not None:
                moved(partition)
        record = LoadRecord(load_id, name, "loaded", partitions, counted["rows"])
        self._note(record)
        self.recover(name)
        return record

    def table(self, name: str, *columns: str) -> DataFrame:
        """The table after its whole loads; one that died half way is undone first."""
        self.recover(name)
        return Warehouse(self.spark, path=self.path).table(name, *columns)

    def loads(self, name: str) -> DataFrame:
        """The records of a table: one row a load, with its furthest state."""
        found = []
        for load_id in self._children("_ledger", name):
            record = self._noted(name, load_id, "loaded") or self._noted(name, load_id, "moving")
            if record is not None:
                found.append(asdict(record))
        return self.spark.createDataFrame(found, LOADS)
