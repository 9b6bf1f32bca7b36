"""A table of Parquet folders, of which a small version file names those that count.

A writer adds a folder, merges folders into one when there are more than a few,
and then commits a version: the file is written under another name and renamed
over the final one, so a reader sees the version before or the one after and
nothing in between.  Folders that a replaced version still names are kept for
the next ``keep`` versions, for readers on their way and for a batch that is
replayed.  There is one writer (a stream, or a job); there may be many readers.

All access goes through Hadoop's file API: the path may be in any store that
Spark reads.  A version names at most ``most`` folders, so what a reader lists
does not grow with the number of commits.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Snapshots:
    def __init__(self, spark: SparkSession, path: str, most: int = 8, keep: int = 2):
        self.spark, self.path, self.most, self.keep = spark, path.rstrip("/"), most, keep

    # ---- files

    def _hadoop(self, *names: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _names(self, folder: str) -> list[str]:
        fs, path = self._hadoop(folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _load(self, version: int) -> dict:
        fs, path = self._hadoop("versions", f"{version:020d}.json")
        reader = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
        try:
            return json.loads(reader.readLine())
        finally:
            reader.close()

    # ---- versions

    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in self._names("versions") if n.endswith(".json") and n[0].isdigit())

    def state(self, upto: int | None = None) -> dict:
        """The newest version (not above ``upto``): ``{"parts": [...], ...}``; empty before the first."""
        found = [v for v in self.versions() if upto is None or v <= upto]
        return self._load(found[-1]) if found else {"parts": []}

    def commit(self, version: int, state: dict) -> None:
        """Make ``state`` the version; a replay replaces its own."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        fs, there = self._hadoop("versions", f"{version:020d}.json")
        _, aside = self._hadoop("versions", f".{uuid.uuid4().hex}")
        out = fs.create(aside)
        out.write((json.dumps(state) + "\n").encode())
        out.close()
        options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            there.toUri(), self.spark._jsc.hadoopConfiguration()).rename(aside, there, options)
        self._clean()

    def _clean(self) -> None:
        versions = self.versions()
        kept, old = versions[-self.keep:], versions[:-self.keep]
        if not old:
            return
        named = {p["name"] for v in kept for p in self._load(v)["parts"]}
        for v in old:
            gone = {p["name"] for p in self._load(v)["parts"]} - named
            for name in sorted(gone):
                fs, path = self._hadoop("parts", name)
                fs.delete(path, True)
            fs, path = self._hadoop("versions", f"{v:020d}.json")
            fs.delete(path, False)

    # ---- rows

    def write_part(self, rows: DataFrame, name: str, **facts) -> dict:
        """Write a folder (again, if a replay does); it counts once a version names it."""
        rows.write.mode("overwrite").parquet(f"{self.path}/parts/{name}")
        return {"name": name, **facts}

    def read(self, parts: list[dict], schema: StructType | str) -> DataFrame:
        """The rows of some parts; only their folders are listed."""
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/parts/{p['name']}" for p in parts])
