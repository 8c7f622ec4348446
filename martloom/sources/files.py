"""Small files and folders on whatever file system a path is on.

``create_new`` and ``publish_new`` never replace a file: of several callers one succeeds, as far
as the file system keeps creation and renaming exclusive, which HDFS does. Hadoop's local file system
looks first and creates afterwards, so there the platform's own exclusive calls are used.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_TAKEN = "FileAlreadyExistsException"


class Files:
    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def _at(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._conf()), target

    def _conf(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def exists(self, path: str) -> bool:
        fs, target = self._at(path)
        return fs.exists(target)

    def names(self, path: str) -> list[str]:
        """Names of what is directly below a folder, sorted; none when it is missing."""
        fs, target = self._at(path)
        if not fs.exists(target):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(target))

    def size(self, path: str) -> int:
        """Bytes below a path."""
        fs, target = self._at(path)
        return fs.getContentSummary(target).getLength() if fs.exists(target) else 0

    def modified(self, path: str) -> float:
        """Seconds since the epoch."""
        fs, target = self._at(path)
        return fs.getFileStatus(target).getModificationTime() / 1000

    def delete(self, path: str) -> None:
        fs, target = self._at(path)
        fs.delete(target, True)

    def _local(self, path: str):
        """The path as the platform's, where it is on a local file system; else None."""
        fs, target = self._at(path)
        whole = fs.makeQualified(target).toUri()
        if whole.getScheme() != "file":
            return None
        return self.spark._jvm.java.nio.file.Path.of(whole.getPath(), self._none("java.lang.String"))

    def _none(self, kind: str):
        """No arguments of a Java type, where a method takes any number."""
        owner = self.spark._jvm
        for name in kind.split("."):
            owner = getattr(owner, name)
        return self.spark.sparkContext._gateway.new_array(owner, 0)

    def _claim(self, path: str) -> bool:
        """Create a local file, empty; False when it is there already."""
        nio, local = self.spark._jvm.java.nio.file, self._local(path)
        try:
            nio.Files.createDirectories(local.getParent(), self._none("java.nio.file.attribute.FileAttribute"))
            nio.Files.createFile(local, self._none("java.nio.file.attribute.FileAttribute"))
        except Py4JJavaError as error:
            if _TAKEN in str(error.java_exception):
                return False
            raise
        return True

    def create_new(self, path: str, content: object) -> bool:
        """Write a new file; False when it is there already."""
        fs, target = self._at(path)
        local = self._local(path) is not None
        if local and not self._claim(path):
            return False
        try:
            out = fs.create(target, local)
        except Py4JJavaError as error:
            if _TAKEN in str(error.java_exception):
                return False
            raise
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        return True

    def publish_new(self, path: str, content: object) -> bool:
        """Like ``create_new``, but the file appears with its content or not at all."""
        staged = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        self.create_new(staged, content)
        if (local := self._local(path)) is not None:
            try:  # a second name for the file, which unlike renaming never replaces one
                self.spark._jvm.java.nio.file.Files.createLink(local, self._local(staged))
            except Py4JJavaError as error:
                if _TAKEN in str(error.java_exception):
                    return False
                raise
            finally:
                self.delete(staged)
            return True
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        source, target = hadoop.Path(staged), hadoop.Path(path)
        context = hadoop.FileContext.getFileContext(self._at(path)[0].getUri(), self._conf())
        no_options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(source, target, no_options)
        except Py4JJavaError as error:
            self.delete(staged)
            if _TAKEN in str(error.java_exception):
                return False
            raise
        return True

    def read(self, path: str) -> object:
        fs, target = self._at(path)
        stream = fs.open(target)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)
