"""Files beside tables: on the driver by Hadoop's file systems, in tasks by Python's."""

import os
import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder of any file system that Spark knows; names are relative to it, "" is itself."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark.sparkContext._jvm
        start = self._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
        self._fs = start.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.uri = self._fs.makeQualified(start).toString()  # names its file system, for use in tasks

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.uri}/{name}" if name else self.uri)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def make(self, name: str = "") -> None:
        self._fs.mkdirs(self._at(name))

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)

    def names(self, name: str = "") -> list[str]:
        """What lies in a folder; nothing if there is none."""
        if not self.exists(name):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._at(name)))

    def files(self, name: str) -> list[str]:
        """Data files in a folder and those below, as names in it."""
        found, waiting = [], [""]
        while waiting:
            inner = waiting.pop()
            for status in self._fs.listStatus(self._at(f"{name}/{inner}".rstrip("/"))):
                own = status.getPath().getName()
                if own[0] in "._":
                    continue
                place = f"{inner}/{own}".lstrip("/")
                (waiting if status.isDirectory() else found).append(place)
        return sorted(found)

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._at(source), self._at(target)):
            raise OSError(f"{source} could not be renamed to {target} in {self.uri}")

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The whole text or nothing: it is written under another name first."""
        draft = f"_draft-{uuid.uuid4().hex}"
        stream = self._fs.create(self._at(draft), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.rename(draft, name)


def mounted(uri: str) -> str | None:
    """The path of a ``Folder.uri`` that every machine mounts; None on other file systems."""
    return "/" + uri.removeprefix("file:").lstrip("/") if uri.startswith("file:") else None


def names_in_task(uri: str) -> list[str]:
    place = mounted(uri)
    if place is not None:
        return os.listdir(place) if os.path.isdir(place) else []
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return [info.base_name for info in found]


def bytes_in_task(uri: str, name: str) -> bytes:
    place = mounted(uri)
    if place is not None:
        with open(f"{place}/{name}", "rb") as file:
            return file.read()
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    with system.open_input_file(f"{path}/{name}") as file:
        return file.read()


class Lines:
    """A new file in a task to which lines are added one by one.

    Every line is on its way to the disk when ``add`` returns. File systems that keep a file only
    once it is closed get a file for each line.
    """

    KEEPING = ("file:", "hdfs:")

    def __init__(self, uri: str, name: str):
        self.uri, self.name, self._out, self._files = uri, name, None, 0

    def _open(self):
        name = f"{self.name}-{uuid.uuid4().hex}"
        place = mounted(self.uri)
        if place is not None:
            os.makedirs(place, exist_ok=True)
            return open(f"{place}/{name}", "ab", buffering=0)
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.uri)
        system.create_dir(path, recursive=True)
        return system.open_output_stream(f"{path}/{name}", compression=None)

    def add(self, line: bytes) -> None:
        if self._out is None:
            self._out = self._open()
        self._out.write(line + b"\n")
        if not self.uri.startswith(self.KEEPING):
            self.close()
        elif mounted(self.uri) is not None:
            os.fsync(self._out.fileno())
        else:
            self._out.flush()

    def close(self) -> None:
        if self._out is not None:
            self._out.close()
            self._out = None
