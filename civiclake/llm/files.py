"""Files in the shared folder, read and written inside tasks through pyarrow's file systems.

``spark.checkpoint.dir`` may be a plain path or a ``file:``, ``hdfs:`` or ``s3:`` address; every executor
must reach it. A file is written under a name of its attempt and then moved, so a repeated or speculative
task replaces a whole file by an equal one.
"""

from __future__ import annotations

import re
import uuid

from pyarrow import fs


def locate(address: str) -> tuple[fs.FileSystem, str]:
    """File system and path of an address."""
    if "://" not in address:
        address = re.sub(r"^file:/*", "/", address)
        return fs.LocalFileSystem(), address
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", address))


def make_folder(address: str) -> None:
    files, path = locate(address)
    files.create_dir(path, recursive=True)


class Writer:
    """A file that appears under its name only when it is complete."""

    def __init__(self, folder: str, name: str):
        self.files, root = locate(folder)
        self.path, self.draft = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
        self.size = 0
        self.stream = self.files.open_output_stream(self.draft)

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()
        self.files.move(self.draft, self.path)


def open_file(address: str):
    """A file open for reading at any place."""
    files, path = locate(address)
    return files.open_input_file(path)
