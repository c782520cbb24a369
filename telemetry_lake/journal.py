"""The landing journal: which files of a batch count, whatever a landing was broken off at.

Two folders beside the raw partitions, hidden from scans by their name:

* `open/<batch>`: a landing is under way; its attempt and hours, written before any file of it;
* `done/<batch>/<number>`: the hours and files of a finished version; the highest number counts.

A version becomes the one that counts in the moment its manifest appears. Until the open
entry goes, readers pass over the files of the attempt that has no manifest yet and of
versions that no longer count. A batch is landed by one writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from telemetry_lake import storage


@dataclass(frozen=True)
class Landing:
    """One version of a batch: its number, the attempt that wrote it, hours as (dt, hour), and files."""

    number: int
    attempt: str
    hours: tuple[tuple[str, str], ...]
    files: tuple[str, ...] = ()


def base_name(batch: str, attempt: str) -> str:
    """What the names of an attempt's files start with, before a dash."""
    return f"batch_{batch}.{attempt}"


class Journal:
    """The journal of one raw folder."""

    def __init__(self, spark: SparkSession, raw_path: str):
        self.spark, self.raw_path = spark, raw_path
        self._open, self._done = f"{raw_path}/_landing/open", f"{raw_path}/_landing/done"

    def _read(self, path: str) -> Landing:
        values = json.loads(storage.read_text(self.spark, path))
        return Landing(values["number"], values["attempt"], tuple(map(tuple, values["hours"])), tuple(values["files"]))

    def _write(self, path: str, landing: Landing) -> None:
        storage.write_text(self.spark, path, json.dumps(asdict(landing)))

    def under_way(self, batch: str) -> Landing | None:
        path = f"{self._open}/{batch}"
        return self._read(path) if storage.exists(self.spark, path) else None

    def versions(self, batch: str) -> list[int]:
        return sorted(int(name) for name in storage.children(self.spark, f"{self._done}/{batch}") if name.isdigit())

    def version(self, batch: str, number: int) -> Landing:
        return self._read(f"{self._done}/{batch}/{number}")

    def begin(self, batch: str, landing: Landing) -> None:
        storage.make_folder(self.spark, self._open)
        self._write(f"{self._open}/{batch}", landing)

    def commit(self, batch: str, landing: Landing) -> None:
        storage.make_folder(self.spark, f"{self._done}/{batch}")
        self._write(f"{self._done}/{batch}/{landing.number}", landing)

    def settle(self, batch: str) -> None:
        """Finish or undo what is under way: remove files that do not count, then what names them."""
        started, versions = self.under_way(batch), self.versions(batch)
        if started and started.number not in versions:
            self._remove(self.files_of(batch, started))
        for number in versions[:-1]:
            self._remove(self.version(batch, number).files)
            storage.delete(self.spark, f"{self._done}/{batch}/{number}")
        storage.delete(self.spark, f"{self._open}/{batch}")

    def _remove(self, files: Iterable[str]) -> None:
        for file in files:
            storage.delete(self.spark, file)

    def files_of(self, batch: str, landing: Landing) -> list[str]:
        """The files an attempt has left in its hours, by their name."""
        # A folder that the attempt did not come to make has none; one listing tells which dates are there.
        made = set(storage.children(self.spark, self.raw_path))
        days = {f"dt={dt}": f"{self.raw_path}/dt={dt}" for dt, _ in landing.hours if f"dt={dt}" in made}
        start = base_name(batch, landing.attempt) + "-"
        return [file for file in storage.files_in(self.spark, days.values()) if file.rsplit("/", 1)[-1].startswith(start)]

    def hidden(self) -> set[str]:
        """Starts of the names of files that do not count now; empty unless a landing is under way."""
        starts = set()
        for batch in storage.children(self.spark, self._open):
            started = self.under_way(batch) if "." not in batch else None
            if started is None:
                continue
            versions = self.versions(batch)
            if started.number not in versions:
                starts.add(base_name(batch, started.attempt) + "-")
            starts.update(base_name(batch, self.version(batch, n).attempt) + "-" for n in versions[:-1])
        return starts
