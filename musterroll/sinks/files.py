"""Folders and small files of any file system that Spark's own Hadoop client reaches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    path: str
    is_folder: bool
    modified_ms: int


class Files:
    """Operations of one session; contents other than small texts never pass through it."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def system(self, name: str):
        return self.path(name).getFileSystem(self._conf)

    def exists(self, name: str) -> bool:
        return self.system(name).exists(self.path(name))

    def entries(self, folder: str) -> list[Entry]:
        """What lies directly in ``folder``, by name; nothing if it is not there."""
        if not self.exists(folder):
            return []
        found = [
            Entry(s.getPath().getName(), s.getPath().toString(), s.isDirectory(), s.getModificationTime())
            for s in self.system(folder).listStatus(self.path(folder))
        ]
        return sorted(found, key=lambda entry: entry.name)

    def make_folder(self, name: str) -> None:
        self.system(name).mkdirs(self.path(name))

    def write_text(self, name: str, text: str) -> None:
        """A new small file; one that is there already is an error."""
        out = self.system(name).create(self.path(name), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def move(self, source: str, target: str) -> None:
        """Give a file or folder a new name, which nothing may have yet."""
        if self.exists(target) or not self.system(source).rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move to {target}")

    def remove(self, name: str) -> None:
        self.system(name).delete(self.path(name), True)

    def join(self, target: str, parts: list[str]) -> None:
        """Append ``parts`` in order to the file ``target``, by the file system itself.

        The parts are used up. A file system that cannot join files raises OSError and
        leaves all as it was.
        """
        system = self.system(target)
        first = target
        if system.getScheme() == "file":
            # Without the checksums beside local files, which would not fit; and there a
            # join replaces its target.
            system = system.getRawFileSystem()
            first = f"{target}.joining"
            folder, _, name = target.rpartition("/")
            system.rename(self.path(target), self.path(first))
            system.delete(self.path(f"{folder}/.{name}.crc"), False)
            parts = [first, *parts]
        array = self._jvm.java.lang.reflect.Array.newInstance(self.path(target).getClass(), len(parts))
        for k, part in enumerate(parts):
            array[k] = self.path(part)
        try:
            system.concat(self.path(target), array)
        except Exception as problem:
            if "UnsupportedOperationException" in str(problem):
                raise OSError(f"{system.getScheme()} cannot join files") from problem
            raise
        for part in parts:  # some file systems leave them
            system.delete(self.path(part), False)
