"""Merges with per-column policies, link replacement, and snapshots published by one pointer.

Parquet tables have no MERGE or UPDATE, so a change is a new table: one full
outer join on the key, whose columns follow a policy.  Tables of a store may be kept as
files of key ranges (ranges.py); a change of these is the same join over the files that it touches.
Others only grow: an append writes its own rows as one more folder.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrollspark.operators import ranges
from scrollspark.operators.ranges import Ranged

REPLACE, PRESERVE, NOW = "replace", "preserve", "now"


def merge(target: DataFrame, source: DataFrame, key: str, policy: Mapping[str, str], now: Column | None = None, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Upsert of source into target.

    replace: the source's value for rows that the source has, null included;
    preserve: the target's value, and the default for new rows;
    now: the time for rows that the source has.
    Columns without a policy are preserved.  Source keys must be unique.
    """
    defaults = defaults or {}
    t, s = target.alias("t"), source.withColumn("_matched", F.lit(True)).alias("s")
    both = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    hit, is_new = F.coalesce(F.col("s._matched"), F.lit(False)), F.col(f"t.{key}").isNull()
    out = [F.coalesce(F.col(f"t.{key}"), F.col(f"s.{key}")).alias(key)]
    for name in target.columns:
        if name == key:
            continue
        how, old = policy.get(name, PRESERVE), F.col(f"t.{name}")
        if how == REPLACE:
            value = F.when(hit, F.col(f"s.{name}")).otherwise(old)
        elif how == NOW:
            value = F.when(hit, now if now is not None else F.current_timestamp()).otherwise(old)
        else:
            value = F.when(is_new, F.lit(defaults.get(name))).otherwise(old) if name in defaults else old
        out.append(value.cast(target.schema[name].dataType).alias(name))
    return both.select(*out)


def update_from(target: DataFrame, source: DataFrame, key: str, values: Mapping[str, Column]) -> DataFrame:
    """Rows of target that the source has get new values (columns of "t" and "s"); others stay."""
    both = target.alias("t").join(source.withColumn("_matched", F.lit(True)).alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "left")
    hit = F.coalesce(F.col("s._matched"), F.lit(False))
    return both.select(*((F.when(hit, values[c]).otherwise(F.col(f"t.{c}")) if c in values else F.col(f"t.{c}")).alias(c) for c in target.columns))


def add_new(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Insert that ignores keys that are there already, and repeats within the source."""
    fresh = source.dropDuplicates([key]).join(target.select(key), key, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def replace_links(links: DataFrame, new: DataFrame, key: str = "paper_id", batch: DataFrame | None = None) -> DataFrame:
    """Links of the batch's papers are dropped and the new ones put in; a repeated link counts once."""
    touched = (new if batch is None else batch).select(key).distinct()
    return links.join(touched, key, "left_anti").unionByName(new.select(*links.columns).distinct())


def delete_cascade(papers: DataFrame, links: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Papers without those of gone(id), and links without theirs."""
    return papers.join(gone.select("id"), "id", "left_anti"), links.join(gone.select(F.col("id").alias("paper_id")), "paper_id", "left_anti")


def rename_categories(links: DataFrame, categories: DataFrame, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """names: category, new_category.  A renamed category takes its links along."""
    fix = lambda df: df.join(names, "category", "left").withColumn("category", F.coalesce("new_category", "category")).select(*df.columns)
    return fix(links).distinct(), fix(categories)


RANGED = "ranged:"  # before the path of a list of files, where a plain table has its folder
APPENDED = "appended:"  # the same for a list of folders
CONFLICT = "another writer has published since the tables were read"


class Conflict(RuntimeError):
    """Another writer has published since the tables were read."""


@dataclass(frozen=True)
class Appended:
    """A table as a list of folders, in the order of their appends."""

    spark: SparkSession
    schema: T.StructType
    folders: tuple[str, ...] = ()

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.folders) if self.folders else self.spark.createDataFrame([], self.schema)

    def with_rows(self, rows: DataFrame, folder: str) -> Appended:
        """The table with these rows, written to a new folder."""
        rows.select(*(F.col(f.name).cast(f.dataType) for f in self.schema)).write.parquet(folder)
        return replace(self, folders=(*self.folders, folder))

    def to_json(self) -> str:
        return "\n".join([self.schema.json(), *self.folders])

    @classmethod
    def from_json(cls, spark: SparkSession, text: str) -> Appended:
        head, *folders = text.split("\n")
        return cls(spark, T.StructType.fromJson(json.loads(head)), tuple(folders))


class ByRename:
    """A pointer is written aside and renamed; the file system must refuse a rename onto a file that is there (HDFS does)."""

    def __init__(self, spark: SparkSession, root: str):
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._path, self._root = jvm.org.apache.hadoop.fs.Path, root
        self._fs = self._path(root).getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.makeQualified(self._path(root)).toUri(), conf)
        self._no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        self._no_overwrite[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE

    def put(self, name: str, text: str) -> bool:
        """Whether the file is there now with this text; False if another one was there before."""
        draft = self._path(f"{self._root}/draft-{uuid.uuid4().hex}")
        stream = self._fs.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        try:
            self._files.rename(draft, self._path(f"{self._root}/{name}"), self._no_overwrite)
        except Py4JJavaError as problem:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in str(problem.java_exception):
                return False
            raise
        return True


class IfAbsent:
    """A pointer is put under its name if there is none: for object stores, which show an object when it is whole, and have no rename.

    The store decides when the object is closed, so a refusal can come from any of the three calls.  A request that the client
    sends again after a lost answer is refused because of itself: then the text that is there is the writer's own.
    """

    #: S3 asks for the condition by name; others have it whenever a file is not to be overwritten.
    CONDITION = "fs.option.create.conditional.overwrite"

    def __init__(self, spark: SparkSession, root: str):
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._path, self._root, self._text_of = jvm.org.apache.hadoop.fs.Path, root, jvm.org.apache.commons.io.IOUtils.toString
        self._fs = self._path(root).getFileSystem(conf)

    def put(self, name: str, text: str) -> bool:
        """Whether the file is there now with this text; False if another one was there before."""
        target, mark = self._path(f"{self._root}/{name}"), f"#{uuid.uuid4().hex}\n"
        try:
            stream = self._fs.createFile(target).overwrite(False).recursive().opt(self.CONDITION, "true").build()
            stream.write(bytearray((text + mark).encode()))
            stream.close()
        except Py4JJavaError:
            if not self._fs.exists(target):
                raise  # not a refusal
            found = self._fs.open(target)
            try:
                return str(self._text_of(found, "UTF-8")).endswith(mark)
            finally:
                found.close()
        return True


#: File systems whose pointers are put if absent; the others rename.
OBJECT_STORES = ("s3a", "s3", "gs", "abfs", "abfss", "wasb", "wasbs")


class SnapshotStore:
    """Tables in one folder; a snapshot of all of them becomes visible by one pointer file.

    Writers put every version in a folder of its own and never touch one that is read;
    a batch of several tables is published at once or not at all.  Pointers are
    numbered.  In a unit of work, from begin() on, every publication takes the number after the
    oldest pointer read, or after the unit's own last one: if another writer has that
    number, Conflict is raised and nothing changes.

    commits: how a pointer becomes visible, ByRename or IfAbsent; by the scheme of root, if not given.
    """

    def __init__(self, spark: SparkSession, root: str, commits: type[ByRename] | type[IfAbsent] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if commits is None:
            commits = IfAbsent if str(self._fs.getUri().getScheme()) in OBJECT_STORES else ByRename
        self._commits = commits(spark, self.root)
        self._base: int | None = None

    def begin(self) -> None:
        """A unit of work begins: what was read before does not count."""
        self._base = None

    def _pointer(self) -> tuple[int, dict[str, str]]:
        """The number of the next pointer, and table name to folder of the newest one; both from one listing."""
        names = sorted(str(x.getPath().getName()) for x in (self._fs.globStatus(self._path(f"{self.root}/pointer-*")) or []))
        if not names:
            return 0, {}
        return int(names[-1].removeprefix("pointer-")) + 1, self._tables(names[-1])

    def _tables(self, pointer: str) -> dict[str, str]:
        """Table name to folder, from a pointer of one line a table; a line without a tab is a writer's mark."""
        return dict(line.split("\t") for line in self._text(f"{self.root}/{pointer}").splitlines() if "\t" in line)

    def _seen(self) -> dict[str, str]:
        number, tables = self._pointer()
        self._base = number if self._base is None else min(self._base, number)
        return tables

    def tables(self) -> list[str]:
        return sorted(self._seen())

    def read(self, table: str) -> DataFrame:
        folder = self._seen()[table]
        return self._listed(folder).read() if folder.startswith((RANGED, APPENDED)) else self.spark.read.parquet(folder)

    def _text(self, path: str) -> str:
        """A pointer or a list; read by the driver without a job."""
        stream = self._fs.open(self._path(path))
        try:
            return str(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _listed(self, folder: str) -> Ranged | Appended:
        kind = Ranged if folder.startswith(RANGED) else Appended
        return kind.from_json(self.spark, self._text(folder.split(":", 1)[1]))

    def folder(self, table: str) -> str:
        """A new folder for a version of a table."""
        return f"{self.root}/{table}/v-{uuid.uuid4().hex}"

    def ranged(self, table: str, key: str, also: tuple[str, ...] = (), rows_per_file: int = ranges.ROWS_PER_FILE) -> Ranged:
        """A table as files of key ranges; one that is a plain folder so far is written anew, once it is published."""
        folder = self._seen()[table]
        return self._listed(folder) if folder.startswith(RANGED) else ranges.ranged(self.read(table), self.folder(table), key, also, rows_per_file)

    def appended(self, table: str, schema: str | T.StructType) -> Appended:
        """A table that only grows, empty if there is none; a plain one counts as its first folder."""
        folder = self._seen().get(table)
        if folder is None:
            return Appended(self.spark, self.spark.createDataFrame([], schema).schema)
        return self._listed(folder) if folder.startswith(APPENDED) else Appended(self.spark, self.spark.createDataFrame([], schema).schema, (folder,))

    def changed(self, table: str, keys: DataFrame, change: Callable[[DataFrame], DataFrame], key: str, also: tuple[str, ...] = ()) -> Ranged:
        """A table after a change of the rows of some keys, to be published; files without these keys stay."""
        return self.ranged(table, key, also).changed(keys, change, self.folder(table))

    def _create(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path))
        stream.write(bytearray(text.encode()))
        stream.close()

    def clean(self, keep: int = 3, older_than: float = 7 * 86_400) -> int:
        """Deletes what none of the last pointers needs, and the pointers before; how many files and folders went.

        older_than: seconds; younger pointers count among the last, and younger files may be those of a version that is not published yet.
        """
        limit = (time.time() - older_than) * 1000
        pointers = sorted((str(x.getPath().getName()), x.getModificationTime()) for x in (self._fs.globStatus(self._path(f"{self.root}/pointer-*")) or []))
        old = [name for name, at in pointers[:-keep] if at <= limit]
        plain, files = set(), set()
        for name in (name for name, _ in pointers if name not in old):
            for folder in self._tables(name).values():
                if folder.startswith(RANGED):
                    files |= {folder.removeprefix(RANGED), *(p.path for p in self._listed(folder).parts)}
                elif folder.startswith(APPENDED):
                    files.add(folder.removeprefix(APPENDED))
                    plain |= set(self._listed(folder).folders)
                else:
                    plain.add(folder)
        place = lambda path: str(self._fs.makeQualified(self._path(path)).toUri().getPath())
        plain, files, gone = set(map(place, plain)), set(map(place, files)), 0
        for version in self._fs.globStatus(self._path(f"{self.root}/*/v-*")) or []:
            path = version.getPath()
            if place(str(path)) in plain | files or version.getModificationTime() > limit:
                continue
            used = version.isDirectory() and any(f.startswith(place(str(path)) + "/") for f in files)
            if not used:
                gone += bool(self._fs.delete(path, True))
                continue
            found = self._fs.listFiles(path, True)
            while found.hasNext():
                file = found.next().getPath()
                if place(str(file)) not in files and str(file.getName()).endswith(".parquet"):
                    gone += bool(self._fs.delete(file, False))
        for name in old:
            gone += bool(self._fs.delete(self._path(f"{self.root}/{name}"), False))
        return gone

    def publish(self, *gone: str, **tables: DataFrame | Ranged | Appended) -> None:
        """Writes new versions of some tables, takes others out, and makes that visible at once; Conflict if what was read is no longer the newest."""
        number, now = self._pointer()
        base, self._base, mark = self._base, None, uuid.uuid4().hex
        if base is not None and base != number:
            raise Conflict(CONFLICT)
        for name, df in tables.items():
            folder = f"{self.root}/{name}/v-{mark}"
            if isinstance(df, Ranged | Appended):
                self._create(f"{folder}.list", df.to_json())
                now[name] = f"{RANGED if isinstance(df, Ranged) else APPENDED}{folder}.list"
            else:
                df.write.parquet(folder)
                now[name] = folder
        for name in gone:
            now.pop(name, None)
        if not self._commits.put(f"pointer-{number:012d}", "".join(f"{k}\t{v}\n" for k, v in sorted(now.items()))):
            raise Conflict(CONFLICT)
        self._base = number + 1
