"""File systems that a tree can lie on: mounted folders and whatever pyarrow opens by URI."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import BinaryIO, NamedTuple

from pyarrow import fs


class Entry(NamedTuple):
    path: str
    is_dir: bool
    size: int
    modified_us: int


def join(folder: str, name: str) -> str:
    return f"{folder}/{name}" if folder else name


@dataclass(frozen=True)
class Store:
    """A tree by its root: a path, a ``file:`` URI, or a URI of a scheme that pyarrow knows (``s3:``,
    ``gs:``, ``abfs:``, ``hdfs:``). ``opener`` gives another file system: called with the root, in each
    task, it returns one of pyarrow's and a path on it."""

    root: str
    opener: Callable[[str], tuple[fs.FileSystem, str]] | None = None

    @property
    def mounted(self) -> bool:
        return self.opener is None and (self.root.startswith("file:") or ":" not in self.root.split("/")[0])

    def local(self) -> str:
        path = self.root.removeprefix("file://").removeprefix("file:")
        return os.path.realpath(os.path.expanduser(path))

    def _open(self) -> tuple[fs.FileSystem, str]:
        if self.opener is None:
            # Hadoop's names of the same schemes.
            system, path = fs.FileSystem.from_uri(self.root.replace("s3a://", "s3://", 1))
        else:
            system, path = self.opener(self.root)
        return system, path.rstrip("/")

    def is_folder(self) -> bool:
        if self.mounted:
            return os.path.isdir(self.local())
        system, path = self._open()
        return system.get_file_info(path).type == fs.FileType.Directory

    def entries(self, folder: str) -> Iterator[Entry]:
        """Files and folders right below ``folder``. On a mounted tree a link to a file is a file, and
        links to folders are not followed."""
        if self.mounted:
            with os.scandir(os.path.join(self.local(), folder)) as found:
                for entry in found:
                    if entry.is_dir(follow_symlinks=False):
                        yield Entry(join(folder, entry.name), True, 0, 0)
                    elif entry.is_file():
                        stat = entry.stat()
                        yield Entry(join(folder, entry.name), False, stat.st_size, stat.st_mtime_ns // 1000)
            return
        system, root = self._open()
        for info in system.get_file_info(fs.FileSelector(join(root, folder) if folder else root)):
            if info.type == fs.FileType.Directory:
                yield Entry(join(folder, info.base_name), True, 0, 0)
            elif info.type == fs.FileType.File:
                yield Entry(join(folder, info.base_name), False, info.size, (info.mtime_ns or 0) // 1000)

    def reader(self) -> Reader:
        return Reader(self)


class Reader:
    """Opens files of a store; one connection for a task."""

    def __init__(self, store: Store) -> None:
        self.system, self.root = (None, store.local()) if store.mounted else store._open()

    def open(self, name: str) -> BinaryIO:
        """A file that reads ranges: only what is asked for is fetched."""
        path = join(self.root, name)
        return open(path, "rb", buffering=512) if self.system is None else self.system.open_input_file(path)

    def size(self, name: str) -> int:
        path = join(self.root, name)
        if self.system is None:
            return os.path.getsize(path)
        return self.system.get_file_info(path).size or 0
