"""A sink that writes a file for each row: ``df.write.format("text_files").option("path", folder)``.

Each task's attempt writes below a staging folder of its own; only when all tasks are done are the files of those that
succeeded moved to their names, and the staging folder goes. So an attempt that fails leaves no file, whole or
half. The folder is one that driver and executors share, by any path that pyarrow's file systems know. For files
that people read: the driver moves each file."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType


@dataclass
class Written(WriterCommitMessage):
    names: list[str]
    folder: str


class _Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"

    def _files(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)

    def write(self, rows: Iterator[Row]) -> Written:
        files, root = self._files()
        folder, names = f"{self.staging}/{uuid.uuid4().hex}", []
        files.create_dir(f"{root}/{folder}", recursive=True)
        for row in rows:
            name = str(row["name"])
            if not name or name.startswith(("/", "_")) or ".." in name.split("/"):
                raise ValueError(f"not a file's name: {name!r}")
            with files.open_output_stream(f"{root}/{folder}/{len(names)}") as out:
                out.write((row["text"] or "").encode())
            names.append(name)
        return Written(names, folder)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        files, root = self._files()
        moves = [(f"{root}/{m.folder}/{i}", f"{root}/{name}") for m in messages if m for i, name in enumerate(m.names)]
        targets = [b for _, b in moves]
        if len(set(targets)) < len(targets):
            self.abort(messages)
            raise ValueError("two rows have one name")
        if self.overwrite:
            for old in files.get_file_info(fs.FileSelector(root, recursive=False)):
                if not old.base_name.startswith("_staging-"):
                    files.delete_dir(old.path) if old.type == fs.FileType.Directory else files.delete_file(old.path)
        for folder in sorted({b.rpartition("/")[0] for b in targets}):
            files.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda m: files.move(*m), moves))
        files.delete_dir(f"{root}/{self.staging}")
        with files.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        files, root = self._files()
        if files.get_file_info(f"{root}/{self.staging}").type.name != "NotFound":
            files.delete_dir(f"{root}/{self.staging}")


class TextFiles(DataSource):
    """Rows of name (below the folder, with subfolders) and text (UTF-8; null: empty)."""

    @classmethod
    def name(cls) -> str:
        return "text_files"

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite)


def write_files(df: DataFrame, path: str, name: Column, text: Column, mode: str = "overwrite") -> None:
    """A file for each row of ``df``; two rows of one name are an error, and nothing is written."""
    df.sparkSession.dataSource.register(TextFiles)
    df.select(name.alias("name"), text.alias("text")).write.format("text_files").mode(mode).option("path", path).save()
