"""Outputs that replace older ones all at once or not at all."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from editpulse.sources.storage import file_system, hadoop_path, visible_files


class Release:
    """A set of outputs below ``root``: written aside, then moved into place, the marker last.

    ``with Release(spark, root) as out:`` gives paths to write to by ``out.path(place)``; ``out.publish``
    moves them. Moves are renames within one file system. What a place held before is set aside
    first and put back if any move fails, so readers, who go by the marker, find either
    release whole. A run that ends before `publish` leaves nothing behind.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = file_system(spark, self.root)
        self.aside = f"{self.root}/_release-{uuid.uuid4().hex}"
        self.places: dict[str, bool] = {}

    def __enter__(self) -> Release:
        return self

    def __exit__(self, *_: object) -> None:
        self.files.delete(self._at(self.aside), True)

    def _at(self, path: str):
        return hadoop_path(self.spark, path)

    def path(self, place: str, single: bool = False) -> str:
        """Where to write what shall be at ``place``.

        With ``single``, a folder with one part file becomes that file; one with more stays a
        folder whose part files, in order of name, are the content.
        """
        place = place.removeprefix(f"{self.root}/")
        self.places[place] = single
        return f"{self.aside}/new/{place}"

    def _move(self, source: str, target: str) -> None:
        self.files.mkdirs(self._at(target).getParent())
        if not self.files.rename(self._at(source), self._at(target)):
            raise OSError(f"could not move {source} to {target}")

    def _written(self, place: str) -> str:
        folder = f"{self.aside}/new/{place}"
        if self.places[place]:
            names = visible_files(self.spark, folder)
            if len(names) == 1:
                return f"{folder}/{names[0]}"
        return folder

    def publish(self, marker: str, text: str) -> None:
        """Move every output to its place, then the file ``marker`` with ``text``."""
        stream = self.files.create(self._at(f"{self.aside}/new/{marker}"), True)
        stream.write(f"{text}\n".encode())
        stream.close()
        sources = {place: self._written(place) for place in self.places} | {marker: f"{self.aside}/new/{marker}"}
        moved: list[tuple[str, bool]] = []
        try:
            for place, source in sources.items():
                target, old = f"{self.root}/{place}", f"{self.aside}/old/{place}"
                held = self.files.exists(self._at(target))
                if held:
                    self._move(target, old)
                moved.append((place, held))
                self._move(source, target)
        except BaseException:
            for place, held in reversed(moved):
                target = f"{self.root}/{place}"
                self.files.delete(self._at(target), True)
                if held:
                    self._move(f"{self.aside}/old/{place}", target)
            raise


def replace_folder(spark: SparkSession, written: str, target: str) -> None:
    """Move the folder ``written`` to ``target``; what was there goes after the move."""
    files, old = file_system(spark, target), f"{target.rstrip('/')}-old-{uuid.uuid4().hex}"
    new, there = hadoop_path(spark, written), hadoop_path(spark, target)
    files.mkdirs(there.getParent())
    held = files.exists(there)
    if held and not files.rename(there, hadoop_path(spark, old)):
        raise OSError(f"could not set {target} aside")
    if not files.rename(new, there):
        if held:
            files.rename(hadoop_path(spark, old), there)
        raise OSError(f"could not move {written} to {target}")
    files.delete(hadoop_path(spark, old), True)
