"""Byte ranges of files in any store that pyarrow reads: local paths and URIs (file, hdfs, s3, gs)."""

from __future__ import annotations

from fnmatch import fnmatch


def store(path: str):
    """The store of a path, and the path within it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return fs.LocalFileSystem(), path


def listed(path: str, glob: str) -> list[tuple[str, int]]:
    """Files under a folder, or the file itself, with their sizes, in order; paths as the store's own with its scheme."""
    from pyarrow import fs

    files, inner = store(path)
    scheme = path[: path.index("://") + 3] if "://" in path and not path.startswith("file:") else ""
    own = files.get_file_info(inner)
    if own.type == fs.FileType.File:
        return [(path, own.size)]
    found = files.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted((scheme + f.path, f.size) for f in found if f.type == fs.FileType.File and fnmatch(f.base_name, glob))


class Ranges:
    """A file of which only the ranges asked for are read."""

    def __init__(self, path: str):
        files, inner = store(path)
        self._file = files.open_input_file(inner)
        self.size = self._file.size()
        self.bytes_read = 0

    def read(self, at: int, n: int) -> bytes:
        out = self._file.read_at(n, at)
        self.bytes_read += len(out)
        if len(out) < n:
            raise ValueError(f"the file ends at {at + len(out)}, before {at + n}")
        return out

    def upto(self, at: int, n: int) -> bytes:
        """Like read, but less where the file ends."""
        return self.read(at, max(0, min(n, self.size - at)))

    def close(self) -> None:
        self._file.close()
