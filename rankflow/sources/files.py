"""Files as a whole: joining parts, and publishing what was written completely."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

MANIFESTS = "_manifests"


class Files:
    """The file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._jvm = context._jvm
        self._system = self.path(path).getFileSystem(context._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def parts(self, folder: str) -> list[tuple[str, int]]:
        """Files of a folder with their lengths, in the order of their names; hidden ones are left out."""
        if not self._system.exists(self.path(folder)):
            return []
        found = [(status.getPath(), status.getLen()) for status in self._system.listStatus(self.path(folder))]
        return sorted((path.toString(), size) for path, size in found if path.getName()[0] not in "_.")

    def exists(self, name: str) -> bool:
        return self._system.exists(self.path(name))

    def is_file(self, name: str) -> bool:
        return self.exists(name) and self._system.getFileStatus(self.path(name)).isFile()

    def delete(self, name: str) -> None:
        self._system.delete(self.path(name), True)

    def read(self, name: str) -> str:
        stream = self._system.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, content: str) -> None:
        """Appears under its name only once it is whole."""
        hidden = self.path(f"{name}._writing")
        stream = self._system.create(hidden, True)
        try:
            stream.write(bytearray(content.encode()))
        finally:
            stream.close()
        self.delete(name)
        if not self._system.rename(hidden, self.path(name)):
            raise OSError(f"cannot place {name}")

    def concatenate(self, target: str, sources: list[str]) -> None:
        """Joins files without reading them where the file system can."""
        gateway = self._jvm.java.lang.reflect.Array
        system = self._system
        if system.getScheme() == "file":
            # The local file system joins files below its checksums; it begins a new target.
            system, first = system.getRawFileSystem(), []
        else:
            first, sources = sources[:1], sources[1:]
        if first and not system.rename(self.path(first[0]), self.path(target)):
            raise OSError(f"cannot place {target}")
        if not sources:
            return
        array = gateway.newInstance(self.path(target).getClass(), len(sources))
        for i, source in enumerate(sources):
            gateway.set(array, i, self.path(source))
        system.concat(self.path(target), array)


def join_files(spark: SparkSession, folders: list[str], target: str) -> None:
    """One file of the parts of all folders, in order; the folders go.

    Tasks have written the parts in parallel. File systems that can't join files raise an error, and the parts stay.
    """
    files = Files(spark, target)
    parts = [name for folder in folders for name, size in files.parts(folder) if size]
    try:
        if parts:
            files.concatenate(target, parts)
        else:
            files.write(target, "")
    except Py4JJavaError as error:
        raise OSError(f"{target}: the file system does not join files; write parts instead") from error
    for folder in folders:
        files.delete(folder)
    files.write(f"{target.rsplit('/', 1)[0]}/_SUCCESS", "")


# --- manifests -----------------------------------------------------------------------------------


def _manifest(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{MANIFESTS}/{name}"


def withdraw(spark: SparkSession, folder: str, name: str) -> None:
    """From now on ``name`` counts as absent."""
    Files(spark, folder).delete(_manifest(folder, name))


def publish(spark: SparkSession, folder: str, name: str) -> None:
    """Lists the files of ``folder/name``, which are complete, in a manifest that is written last."""
    files = Files(spark, folder)
    listed = [[path.rsplit("/", 1)[1], size] for path, size in files.parts(f"{folder.rstrip('/')}/{name}")]
    files.write(_manifest(folder, name), json.dumps(listed))


def published(spark: SparkSession, folder: str, name: str) -> list[str] | None:
    """The files that the manifest of ``folder/name`` lists, or ``None`` where there is none or a file is not as listed."""
    files, manifest = Files(spark, folder), _manifest(folder, name)
    if not files.exists(manifest):
        return None
    root = f"{folder.rstrip('/')}/{name}"
    present = {path.rsplit("/", 1)[1]: size for path, size in files.parts(root)}
    listed = json.loads(files.read(manifest))
    if any(present.get(part) != size for part, size in listed):
        return None
    return [f"{root}/{part}" for part, _ in listed]


def published_names(spark: SparkSession, folder: str) -> list[str]:
    """Whatever has a manifest in ``folder``."""
    files = Files(spark, folder)
    names = [path.rsplit("/", 1)[1] for path, _ in files.parts(f"{folder.rstrip('/')}/{MANIFESTS}")]
    return [name for name in names if not name.endswith("._writing")]
