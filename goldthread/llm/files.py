"""Files that tasks write and read themselves, in any store that pyarrow can open."""

from __future__ import annotations

from pyarrow import fs


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it, for a URI or an absolute path."""
    if "://" not in path and path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


def make_folder(path: str) -> None:
    store, place = open_store(path)
    store.create_dir(place, recursive=True)


def rename(source: str, target: str) -> None:
    """Move a file; done already counts as done, so a repeated attempt is harmless."""
    store, a = open_store(source)
    _, b = open_store(target)
    if store.get_file_info(a).type == fs.FileType.NotFound and store.get_file_info(b).type == fs.FileType.File:
        return
    store.move(a, b)
