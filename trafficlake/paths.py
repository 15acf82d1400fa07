"""Folders compared and listed as Hadoop's file systems see them."""

import re
import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _file_system(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def _places(spark: SparkSession, text: str) -> list[tuple[str, ...]]:
    """The path, and what it matches if it is a pattern: each as file system and folder names, from the root."""
    system = _file_system(spark, text)
    found = [system.makeQualified(_path(spark, x)) for x in _alternatives(text)]
    found += [status.getPath() for status in system.globStatus(_path(spark, text)) or []]
    places = []
    for path in found:
        uri = path.toUri().normalize()
        places.append((f"{uri.getScheme()}://{uri.getAuthority() or ''}", *filter(None, uri.getPath().split("/"))))
    return places


def _alternatives(text: str) -> list[str]:
    """A pattern without braces that hold a slash: each alternative as a pattern of its own."""
    group = next((m for m in re.finditer(r"\{([^{}]*)\}", text) if "/" in m[1]), None)
    if group is None:
        return [text]
    parts = [text[: group.start()] + part + text[group.end() :] for part in group[1].split(",")]
    return [x for part in parts for x in _alternatives(part)]


def _within(spark: SparkSession, outer: tuple[str, ...], inner: tuple[str, ...]) -> bool:
    """Whether ``inner``, its names read as patterns too, may be ``outer`` or lie in it."""
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern
    if len(outer) > len(inner) or outer[0] != inner[0]:
        return False
    return all(a == b or pattern(a).matches(b) or pattern(b).matches(a) for a, b in zip(outer[1:], inner[1:]))


def overlap(spark: SparkSession, first: str, second: str) -> bool:
    """Whether one of two folders is or lies in the other; patterns stand for all they match, now or later."""
    pairs = [(a, b) for a in _places(spark, first) for b in _places(spark, second)]
    return any(_within(spark, a, b) or _within(spark, b, a) for a, b in pairs)


def exists(spark: SparkSession, text: str) -> bool:
    return _file_system(spark, text).exists(_path(spark, text))


def has_files(spark: SparkSession, folder: str, suffix: str) -> bool:
    """Whether a file with this ending lies at any depth; the listing stops at the first."""
    files = _file_system(spark, folder).listFiles(_path(spark, folder), True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(suffix):
            return True
    return False


def remove(spark: SparkSession, text: str) -> None:
    """Delete a folder of the library's own scratch space, wherever it lies."""
    _file_system(spark, text).delete(_path(spark, text), True)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that a pattern matches; only the levels it names are listed."""
    found = _file_system(spark, pattern).globStatus(_path(spark, pattern)) or []
    return sorted(status.getPath().toString() for status in found if status.isDirectory())


def total_bytes(spark: SparkSession, pattern: str) -> int:
    """Size of the files below all a path or pattern matches."""
    system = _file_system(spark, pattern)
    found = system.globStatus(_path(spark, pattern)) or []
    return sum(system.getContentSummary(status.getPath()).getLength() for status in found)


def files(spark: SparkSession, folder: str) -> list[str]:
    """Names of all files at any depth below the folder that have content, relative to it. Spark lists them, large
    trees in parallel."""
    listed = spark.read.option("recursiveFileLookup", True).text(folder).inputFiles()
    end = f"{folder.rstrip('/').rpartition('/')[2]}/"
    return sorted(unquote(name).partition(end)[2] for name in listed)


def same_file_system(spark: SparkSession, first: str, second: str) -> bool:
    return _file_system(spark, first).getUri() == _file_system(spark, second).getUri()


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder to a name that is free, below a folder that need not exist yet."""
    system, goal = _file_system(spark, target), _path(spark, target)
    system.mkdirs(goal.getParent())
    if system.exists(goal) or not system.rename(_path(spark, source), goal):
        raise FileExistsError(f"cannot move {source} to {target}")


def move_all(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """Rename files to names that no other file can have."""
    if not moves:
        return
    system = _file_system(spark, moves[0][1])
    for parent in sorted({target.rpartition("/")[0] for _, target in moves}):
        system.mkdirs(_path(spark, parent))
    for source, target in moves:
        if not system.rename(_path(spark, source), _path(spark, target)):
            raise OSError(f"cannot move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written under a hidden name, then renamed."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}.{uuid.uuid4().hex}"
    stream = _file_system(spark, hidden).create(_path(spark, hidden))
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move(spark, hidden, path)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if it doesn't exist."""
    if not exists(spark, folder):
        return []
    return sorted(status.getPath().getName() for status in _file_system(spark, folder).listStatus(_path(spark, folder)))


def stamp(spark: SparkSession, folder: str) -> str:
    """A text that changes when files come to or leave the folder or a folder in it: number of files, bytes, and the
    latest change of either. One summary and one listing, however many files there are."""
    system = _file_system(spark, folder)
    summary = system.getContentSummary(_path(spark, folder))
    listed = [system.getFileStatus(_path(spark, folder)), *system.listStatus(_path(spark, folder))]
    latest = max(status.getModificationTime() for status in listed)
    return f"{summary.getFileCount()} files, {summary.getLength()} bytes, {latest}"
