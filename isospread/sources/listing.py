"""A data source that lists folders of files, one task a folder."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Names sent at a time.
BATCH_FILES = 10_000


@dataclass
class Folder(InputPartition):
    """One variable's folder: what a task lists."""

    path: str
    var: str


class FolderListing(DataSource):
    """``path, var, fname`` of the files below ``root`` in the folders of ``variables``.

    Options: ``root``, ``variables`` (names joined by commas) and ``contains`` (text that a file's
    name must hold). Folders that aren't asked for are not opened, and names that don't qualify are
    left out where they are listed. Files themselves are never opened, so the number of tasks
    follows the folders and not the files or their sizes. Hidden files, whose names begin with a
    dot or an underscore, are left out, as by other readers.
    """

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return "path STRING, var STRING, fname STRING"

    def reader(self, schema: object) -> FolderReader:
        return FolderReader(self.options)


class FolderReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["root"].rstrip("/")
        self.variables = [v for v in options["variables"].split(",") if v]
        self.contains = options.get("contains", "")

    def partitions(self) -> list[Folder]:
        return [Folder(f"{self.root}/{var}", var) for var in dict.fromkeys(self.variables)]

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        whole = partition.path
        if "://" in whole or whole.startswith("file:"):
            system, place = fs.FileSystem.from_uri(whole)
        else:
            system, place = fs.LocalFileSystem(), whole
        names = sorted(
            info.base_name
            for info in system.get_file_info(fs.FileSelector(place))
            if info.type == fs.FileType.File
            and self.contains in info.base_name
            and not info.base_name.startswith((".", "_"))
        )
        for at in range(0, len(names), BATCH_FILES):
            some = names[at : at + BATCH_FILES]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{whole}/{name}" for name in some], pa.string()),
                    pa.array([partition.var] * len(some), pa.string()),
                    pa.array(some, pa.string()),
                ],
                ["path", "var", "fname"],
            )
