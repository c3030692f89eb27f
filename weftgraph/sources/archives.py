"""Uploaded archives as tables of files: read where they lie, never unpacked to a disk.

An archive is one task's work: it holds at most 10,000 members and 500 MB unpacked, or it is refused.
"""

from __future__ import annotations

import hashlib
import io
import lzma
import posixpath
import re
import stat
import tarfile
import zipfile
import zlib
from collections.abc import Iterable, Iterator
from contextlib import closing
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Limits of an archive, and the names by which its format is told.
MOST_BYTES, MOST_FILES = 500 * 1024 * 1024, 10_000
ZIP_NAMES, TAR_NAMES = (".zip",), (".tar.gz", ".tgz", ".tar")

#: Bytes of files that are handed on at once; a larger file goes alone.
BATCH = 8 << 20

_FILES = "archive string, path string, length long, content binary, error string"
_ARROW = pa.schema([("archive", pa.string()), ("path", pa.string()), ("length", pa.int64()), ("content", pa.binary()), ("error", pa.string())])


class Refused(ValueError):
    """An archive that is not taken, and why."""


class Seekable(io.RawIOBase):
    """An Arrow file as Python's modules want it: a place before its begin is an OSError."""

    def __init__(self, data: pa.NativeFile):
        self.data = data

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        found = self.data.read(len(into))
        into[: len(found)] = found
        return len(found)

    def seek(self, place: int, whence: int = io.SEEK_SET) -> int:
        place += {io.SEEK_SET: 0, io.SEEK_CUR: self.data.tell(), io.SEEK_END: self.data.size()}[whence]
        if place < 0:
            raise OSError("before the begin of the file")
        return self.data.seek(min(place, self.data.size()))

    def tell(self) -> int:
        return self.data.tell()

    def close(self) -> None:
        self.data.close()
        super().close()


def open_file(path: str) -> io.BufferedReader:
    """A file of any file system that Arrow knows, at any place of which one may read."""
    local = re.match(r"(?:file:/*)?(/.*|[^:]*)\Z", path)
    if local:
        data = fs.LocalFileSystem().open_input_file(re.sub(r"\Afile:/*", "/", path))
    else:
        system, name = fs.FileSystem.from_uri(quote(path, safe="/:@"))
        data = system.open_input_file(name)
    return io.BufferedReader(Seekable(data), 1 << 20)


def inside(name: str) -> str | None:
    """The path of a member below the archive's root ('' for the root itself); None if it leads out."""
    path = posixpath.normpath(name)
    if path.startswith("/") or path.split("/")[0] == "..":
        return None
    return "" if path == "." else path


def guarded(members: Iterable[tuple[str, int, bool, bool, object]], most_files: int, most_bytes: int) -> dict[str, object]:
    """Path -> member of the regular files, the last one of a path; refuses before anything is unpacked.

    ``members``: name, size, whether it is a link, whether it is a regular file, the member.
    """
    files, size = {}, 0
    for n, (name, length, link, regular, member) in enumerate(members, 1):
        if n > most_files:
            raise Refused(f"more than {most_files} members")
        if link:
            raise Refused("links are not allowed")
        size += length
        if size > most_bytes:
            raise Refused(f"more than {most_bytes} bytes unpacked")
        path = inside(name)
        if path is None:
            raise Refused("a member leads out of the archive")
        if regular and path:
            files[path] = member
    return files


def contents(name: str, data: io.BufferedReader, *most: int) -> Iterator[tuple[str, bytes]]:
    """(path, content) of the files of an archive."""
    if name.lower().endswith(ZIP_NAMES):
        with zipfile.ZipFile(data) as z:
            listed = ((m.filename, m.file_size, stat.S_ISLNK(m.external_attr >> 16), not m.is_dir(), m) for m in z.infolist())
            for path, member in guarded(listed, *most).items():
                yield path, z.read(member)
    elif name.lower().endswith(TAR_NAMES):
        with tarfile.open(fileobj=data, mode="r:*") as t:
            listed = ((m.name, m.size, m.issym() or m.islnk(), m.isreg(), m) for m in t)
            # in the order of the archive: packed bytes are read on, not from the start again
            for path, member in sorted(guarded(listed, *most).items(), key=lambda x: x[1].offset_data):
                yield path, t.extractfile(member).read()
    else:
        raise Refused("of an unknown format: known are " + ", ".join((*ZIP_NAMES, *TAR_NAMES)))


def unpacked(batches: Iterator[pa.RecordBatch], *most: int) -> Iterator[pa.RecordBatch]:
    """Rows of the files of archives (column path)."""
    for batch in batches:
        for archive in batch["path"].to_pylist():
            rows, held = [], 0
            try:
                with closing(open_file(archive)) as data:
                    for path, content in contents(archive, data, *most):
                        if rows and held + len(content) > BATCH:
                            yield _rows(rows)
                            rows, held = [], 0
                        rows.append((archive, path, len(content), content, None))
                        held += len(content)
            except (Refused, zipfile.BadZipFile, tarfile.TarError, EOFError, zlib.error, lzma.LZMAError, RuntimeError, NotImplementedError) as e:
                # files that were handed on before the damage stay; ``files`` drops all rows of an archive with an error
                rows.append((archive, None, None, None, str(e) if isinstance(e, Refused) else f"not readable: {e}"))
            if rows:
                yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


def members(spark: SparkSession, root: str, archives: str = "*", most_files: int = MOST_FILES, most_bytes: int = MOST_BYTES) -> DataFrame:
    """archive, path, length, content of each file of all archives below a folder; a refused archive has a row with its ``error``.

    Cases: a path that comes twice has its last content; folders, devices and pipes are no files; an
    archive without files has no row; a damaged one may have rows of files before the damage, besides its error.
    The names alone are listed by Spark, and each task opens its archives itself.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", archives).load(root).select("path")
    return listed.repartition("path").mapInArrow(lambda batches: unpacked(batches, most_files, most_bytes), _FILES)


def files(read: DataFrame) -> DataFrame:
    """Files of the archives that have no error; ``read``: a stored table of ``members``."""
    bad = read.where("error IS NOT NULL").select("archive")
    return read.join(bad, "archive", "left_anti").drop("error")


def digests(read: DataFrame) -> DataFrame:
    """archive, digest: sha256 over paths and contents, a folder's files before its folders and both by name; ``read``: of ``files``."""
    parts = F.split("path", "/")
    n = F.size(parts)
    walk = F.transform(parts, lambda part, i: F.concat(F.when(i == n - 1, "0").otherwise("1"), part))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            for archive, path, content in zip(*(batch[c].to_pylist() for c in ("archive", "path", "content")), strict=True):
                if archive != now:
                    if now is not None:
                        yield pa.RecordBatch.from_pydict({"archive": [now], "digest": [state.hexdigest()]})
                    now, state = archive, hashlib.sha256()
                state.update(path.encode())
                state.update(content)
        if now is not None:
            yield pa.RecordBatch.from_pydict({"archive": [now], "digest": [state.hexdigest()]})

    rows = read.select("archive", "path", "content", walk.alias("walk")).repartition("archive").sortWithinPartitions("archive", "walk")
    return rows.select("archive", "path", "content").mapInArrow(work, "archive string, digest string")
