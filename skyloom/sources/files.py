"""Files that tasks read in parts, on any store that pyarrow knows (local paths, file, hdfs, s3, gs)."""

from __future__ import annotations

from pyarrow import fs


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path there."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def listed(path: str, *endings: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files below a folder that have one of the endings; hidden names are passed over."""
    system, at = locate(path)
    prefix = path[: len(path) - len(at)] if path.endswith(at) else path.split(":/", 1)[0] + ":/"
    info = system.get_file_info(at)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = system.get_file_info(fs.FileSelector(at, recursive=True)) if info.type == fs.FileType.Directory else [info]
    kept = [f for f in found if f.is_file and f.base_name[:1] not in "._" and (info.is_file or f.path.lower().endswith(endings))]
    return sorted((prefix + f.path, f.size) for f in kept)


class Part:
    """Reads of byte ranges of one file."""

    def __init__(self, path: str):
        system, at = locate(path)
        self._file = system.open_input_file(at)
        self.size = self._file.size()

    def read(self, start: int, size: int) -> bytes:
        data = self._file.read_at(size, start)
        if len(data) != size:
            raise ValueError(f"the file ends at {start + len(data)}, {start + size} bytes were expected")
        return data

    def __enter__(self) -> Part:
        return self

    def __exit__(self, *_) -> None:
        self._file.close()
