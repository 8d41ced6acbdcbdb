"""Which loads of a store count.

A load takes a number when it begins and is published by one empty file when
all it wrote is there. Readers take rows of published loads only, so a load
that is lost half-way changes nothing: the next one removes what it left. One
writer at a time.
"""

from dataclasses import dataclass

from pyspark.sql import SparkSession

STARTED, DONE = "started", "done"


@dataclass(frozen=True)
class Files:
    """The file system calls a store needs, for any file system that Spark writes to."""

    spark: SparkSession

    def at(self, path):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, path):
        where, files = self.at(path)
        return files.exists(where)

    def names(self, folder):
        """Names of the entries of a folder, sorted; none if there is no such folder."""
        where, files = self.at(folder)
        if not files.exists(where):
            return []
        return sorted(status.getPath().getName() for status in files.listStatus(where))

    def touch(self, path):
        where, files = self.at(path)
        files.create(where, True).close()

    def make(self, folder):
        where, files = self.at(folder)
        files.mkdirs(where)

    def remove(self, path):
        where, files = self.at(path)
        files.delete(where, True)


@dataclass(frozen=True)
class Ledger:
    files: Files
    folder: str

    def _numbers(self, kind):
        marks = [name.split(".") for name in self.files.names(self.folder)]
        return sorted(int(number) for number, what in marks if what == kind)

    def _mark(self, number, kind):
        return f"{self.folder}/{number:09d}.{kind}"

    def published(self):
        """The number of the newest load that counts, 0 before the first.

        Lost loads with a lower number have been removed by their successor.
        """
        return max(self._numbers(DONE), default=0)

    def lost(self):
        """Loads that began and were never published."""
        return sorted(set(self._numbers(STARTED)) - set(self._numbers(DONE)))

    def begin(self, clean):
        """Number of a new load; ``clean(number)`` removes what each lost one has written."""
        taken = self._numbers(STARTED) + self._numbers(DONE)
        for number in self.lost():
            clean(number)
            self.files.remove(self._mark(number, STARTED))
        number = max(taken, default=0) + 1
        self.files.touch(self._mark(number, STARTED))
        return number

    def publish(self, number):
        self.files.touch(self._mark(number, DONE))
        for kind in (STARTED, DONE):
            for old in self._numbers(kind):
                if old < number:
                    self.files.remove(self._mark(old, kind))
