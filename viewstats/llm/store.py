"""Files that tasks write to and read from the shared folder, through Arrow's file systems."""

from __future__ import annotations

import re
import uuid

import pyarrow.fs as pafs


def resolve(root: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a root such as file:/x, file:///x, hdfs://host/x, s3://bucket/x or /x."""
    local = re.match(r"^(?:file:)?/+(.*)$", root)
    return (pafs.LocalFileSystem(), "/" + local[1]) if local else pafs.FileSystem.from_uri(root)


class Store:
    """One folder. New files get names that no other attempt of a task can have, so a task that runs
    again never overwrites; the table of files that its attempt returns says which ones count."""

    def __init__(self, root: str):
        self.fs, self.path = resolve(root)
        self._made = False

    def write(self, prefix: str, data: list[bytes]) -> str:
        if not self._made:
            self.fs.create_dir(self.path, recursive=True)
            self._made = True
        name = f"{prefix}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(f"{self.path}/{name}", compression=None) as out:
            for part in data:
                out.write(part)
        return name

    def open(self, name: str):
        return self.fs.open_input_file(f"{self.path}/{name}")
