"""Several datasets published together: readers see all of an edition or none of it.

Data goes to a folder of its own below ``_data``; an edition is a small file below
``_editions`` that names, for every dataset and partition, the folder that holds it.
A partition is a scenario, or a scenario and year where a dataset is written by both.
It is written aside and renamed to the next number, which fails where another writer
was faster; then the changes are laid over that writer's edition and tried again.
A run that fails on the way leaves data that no edition names, and readers go on
with the edition before. An edition carries what it did not replace.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: dataset -> partition, as its path -> folder of the data.
Places = dict[str, dict[str, str]]

TRIES = 20


class Folder:
    """Small files and listings in the file system that a path belongs to."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.root = self._path(root)
        self.fs = self.root.getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.root, name)

    def names(self, name: str) -> list[str]:
        path = self.at(name)
        return [s.getPath().getName() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> bool:
        """The file with all its text, or False if there is one of that name."""
        target, aside = self.at(name), self.at(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(aside, False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.getFileSystem(self.conf).getUri(), self.conf)
        none = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self.fs.makeQualified(aside), self.fs.makeQualified(target), none)
        except Py4JJavaError as e:
            self.fs.delete(aside, False)
            if "FileAlreadyExistsException" in str(e.java_exception):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The editions there are, oldest first."""
    return sorted(int(n) for n in Folder(spark, root).names("_editions") if n.isdigit())


def places(spark: SparkSession, root: str, edition: int | None = None) -> Places | None:
    """Where an edition's data are, of the last one by default; None without editions."""
    known = numbers(spark, root)
    if edition is None and not known:
        return None
    return json.loads(Folder(spark, root).read(f"_editions/{known[-1] if edition is None else edition:08d}"))


class Draft:
    """Datasets that are written and not published yet."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.id = spark, root, uuid.uuid4().hex
        #: As in an edition; a partition without a folder goes.
        self.changes: dict[str, dict[str, str | None]] = {}

    def write(self, dataset: str, df: DataFrame, by: Sequence[str] = ("scenario",)) -> None:
        """Partitions of a dataset, each in few files; they replace those of the edition before."""
        path = f"_data/{self.id}/{dataset}"
        df.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{self.root}/{path}")
        folder, parts = Folder(self.spark, self.root), [""]
        for column in by:
            parts = [f"{p}/{n}" for p in parts for n in folder.names(f"{path}{p}") if n.startswith(f"{column}=")]
        self.changes.setdefault(dataset, {}).update({p[1:]: self.id for p in parts})

    def drop(self, dataset: str, parts: Collection[str]) -> None:
        """Takes partitions out of a dataset."""
        self.changes.setdefault(dataset, {}).update(dict.fromkeys(parts))

    def read(self, dataset: str) -> DataFrame:
        """A dataset as written in this draft."""
        return self.spark.read.parquet(f"{self.root}/_data/{self.id}/{dataset}")

    def publish(self) -> int:
        folder = Folder(self.spark, self.root)
        for _ in range(TRIES):
            known = numbers(self.spark, self.root)
            now = places(self.spark, self.root) or {}
            for dataset, parts in self.changes.items():
                now[dataset] = {p: i for p, i in (now.get(dataset, {}) | parts).items() if i}
            number = known[-1] + 1 if known else 1
            if folder.write_new(f"_editions/{number:08d}", json.dumps(now, indent=1, sort_keys=True)):
                return number
        raise RuntimeError(f"{TRIES} other writers were faster")


@contextmanager
def draft(spark: SparkSession, root: str) -> Iterator[Draft]:
    """A draft that is published in the end, unless an error comes first."""
    d = Draft(spark, root)
    yield d
    d.publish()


def publish(spark: SparkSession, frames: Mapping[str, DataFrame], root: str) -> None:
    """Some datasets as one edition."""
    with draft(spark, root) as d:
        for dataset, df in frames.items():
            d.write(dataset, df)


def values(spark: SparkSession, part: str) -> dict[str, str]:
    """The columns and values of a partition's path."""
    plain = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    return {column: plain(value) for column, _, value in (p.partition("=") for p in part.split("/"))}


def lookup(
    spark: SparkSession, root: str, dataset: str, scenario: str | None = None, edition: int | None = None, parts: Collection[str] | None = None
) -> DataFrame:
    """A dataset of an edition, one scenario of it, or some of its partitions; no other files are read."""
    found = places(spark, root, edition)
    if found is None or dataset not in found:
        raise KeyError(f"{dataset} is not published")
    by_folder: dict[str, list[str]] = {}
    for part, i in found[dataset].items():
        if (parts is None or part in parts) and (scenario is None or values(spark, part).get("scenario") == scenario):
            by_folder.setdefault(i, []).append(part)
    if not by_folder:
        raise KeyError(f"{dataset} is not published for {parts if scenario is None else scenario}")
    frames = []
    for i, own in sorted(by_folder.items()):
        base = f"{root}/_data/{i}/{dataset}"
        frames.append(spark.read.option("basePath", base).parquet(*(f"{base}/{p}" for p in sorted(own))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def changed_parts(spark: SparkSession, root: str, dataset: str, since: int, edition: int | None = None) -> list[str]:
    """Partitions that one edition has from another run than an earlier one did; by their names alone."""
    before, now = ((places(spark, root, e) or {}).get(dataset, {}) for e in (since, edition))
    return sorted(p for p in {*before, *now} if before.get(p) != now.get(p))


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Removes all but the last editions and the data that only those named; the folders removed.

    For a time without drafts: data of an unfinished one is no edition's.
    """
    folder, known = Folder(spark, root), numbers(spark, root)
    for n in known[:-keep]:
        folder.delete(f"_editions/{n:08d}")
    used = {i for n in known[-keep:] for parts in places(spark, root, n).values() for i in parts.values()}
    gone = sorted(set(folder.names("_data")) - used)
    for i in gone:
        folder.delete(f"_data/{i}")
    return gone
