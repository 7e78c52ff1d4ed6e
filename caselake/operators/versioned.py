"""Tables behind a manifest: a load rewrites the places it touches and switches over at once.

A table is a folder of data files and a folder of versions. Every load writes its files
into a data folder of its own, one sub-folder per place (a hash bucket of the key, or a
value such as the file day), and last a manifest: which sub-folders make up each place.
Readers take the newest manifest, so they see a load whole or not at all, and a load that
dies leaves files nobody reads. Places without a changed row keep their sub-folders, so a
load costs what it touches. The newest ``keep`` versions stay readable; what no kept
version names is removed after each commit.

A manifest also carries what the load wants to remember (``meta``): it becomes true with
the data, which is how a layer knows what it has taken from the layer before.

One writer at a time per table. The number of places is part of a table's definition: a
manifest has one entry per place, whatever the number of rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.operators.merge import minus_keys

PLACE = "caselake_place"
KEEP = 3
BUCKETS = 64


def hashed(keys: list[str], buckets: int = BUCKETS) -> Column:
    """The hash bucket of a key; NULL keys have one, too."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("string")


def valued(column: str) -> Column:
    """A place for every value of a column."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("none"))


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: T.StructType
    places: dict[str, list[str]]
    meta: dict = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "places": self.places, "meta": self.meta})

    @classmethod
    def of(cls, version: int, text: str) -> Manifest:
        held = json.loads(text)
        return cls(version, T.StructType.fromJson(held["schema"]), held["places"], held["meta"])


class VersionedTable:
    """``place`` is where a row belongs; rows that replace each other must share their place."""

    def __init__(self, spark: SparkSession, path: str, place: Column, keep: int = KEEP):
        self.spark, self.path, self.place, self.keep = spark, path.rstrip("/"), place, keep

    # --- reading

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("versions") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> Manifest | None:
        versions = self.versions()
        if not versions:
            return None
        version = version or versions[-1]
        return Manifest.of(version, self._load(f"versions/{version:06d}.json"))

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None, places: Iterable[str] | None = None) -> DataFrame:
        """A version's rows, the newest by default; ``places`` reads only those."""
        known = self.manifest(version)
        if known is None:
            raise FileNotFoundError(self.path)
        wanted = known.places if places is None else [p for p in places if p in known.places]
        return self._rows(known, [f for p in wanted for f in known.places[p]])

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """Rows of the places in which the given keys (the columns of ``place``) belong."""
        return self.read(places=self._places_of(keys))

    def read_new(self, before: Iterable[str], places: Iterable[str] | None = None) -> DataFrame:
        """Rows written by other loads than those in ``before`` (see ``loads``), with rows such loads rewrote."""
        known = self.manifest()
        new = self._new(known, before)
        return self._rows(known, sorted(f for p in (new if places is None else places) for f in new.get(p, ())))

    def places_new(self, before: Iterable[str]) -> set[str]:
        """Places in which ``read_new`` finds rows; the manifest tells."""
        return set(self._new(self.manifest(), before))

    @staticmethod
    def _new(known: Manifest, before: Iterable[str]) -> dict[str, list[str]]:
        taken = set(before)
        new = {p: [f for f in held if f.split("/")[0] not in taken] for p, held in known.places.items()}
        return {p: held for p, held in new.items() if held}

    def loads(self) -> list[str]:
        """Names of the loads whose files the newest version holds."""
        known = self.manifest()
        return sorted({f.split("/")[0] for f in self._folders(known)}) if known else []

    def depth(self) -> int:
        """The most folders a place of the newest version consists of: appended loads lie side by side."""
        known = self.manifest()
        return max(map(len, known.places.values()), default=0) if known else 0

    @staticmethod
    def _folders(known: Manifest) -> set[str]:
        return {f for held in known.places.values() for f in held}

    def _rows(self, known: Manifest, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], known.schema)
        return self.spark.read.schema(known.schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    # --- writing

    def append(self, rows: DataFrame, meta: dict | None = None, dealt: bool = False) -> Manifest:
        """Add rows; refuses a changed type. Columns that come later are NULL in earlier rows.

        ``dealt`` says that the rows come from files that lie by the same places, so that a task
        meets few of them: they are then written where they are read.
        """
        known = self.manifest()
        if known is None:
            return self.overwrite(rows, meta, dealt)
        schema = self._widened(known.schema, rows.schema)
        added = self._write(rows, token := self._token(), dealt)
        places = {p: [*known.places.get(p, []), *([f"{token}/{added[p]}"] if p in added else [])] for p in {*known.places, *added}}
        return self._commit(known.version + 1, schema, places, {**known.meta, **(meta or {})})

    def overwrite(self, rows: DataFrame, meta: dict | None = None, dealt: bool = False) -> Manifest:
        """Replace the whole table. ``rows`` may come from the table itself."""
        known = self.manifest()
        written = self._write(rows, token := self._token(), dealt)
        places = {p: [f"{token}/{f}"] for p, f in written.items()}
        return self._commit(known.version + 1 if known else 1, rows.schema, places, {**(known.meta if known else {}), **(meta or {})})

    def replace(self, rows: DataFrame, keys: list[str], stale: DataFrame | None = None, meta: dict | None = None) -> Manifest:
        """Delete the rows whose key is in ``stale`` (by default, in ``rows``) and insert ``rows``.

        ``rows`` are computed and written once; of the places they or a stale key belong to,
        the rows that stay are written beside them. Nothing else is read or written.
        """
        known = self.manifest()
        if known is None:
            return self.overwrite(rows, meta)
        schema = self._widened(known.schema, rows.schema)
        written = self._write(rows, token := self._token())
        inserted = [f"{self.path}/data/{token}/{f}" for f in written.values()]
        gone = stale if stale is not None else (self.spark.read.schema(rows.schema).parquet(*inserted) if inserted else rows.limit(0))
        touched = {*written, *(self._places_of(stale) if stale is not None else ())}
        old = [f for p in touched for f in known.places.get(p, [])]
        if old:
            staying = minus_keys(self._rows(known, old), gone.select(*keys), keys)
            written |= self._write(staying, token)
        places = {p: f for p, f in known.places.items() if p not in touched} | {p: [f"{token}/{f}"] for p, f in written.items()}
        return self._commit(known.version + 1, schema, places, {**known.meta, **(meta or {})})

    def delete(self, stale: DataFrame, keys: list[str], meta: dict | None = None) -> Manifest:
        known = self.manifest()
        return self.replace(self.spark.createDataFrame([], known.schema), keys, stale, meta)

    def remember(self, meta: dict) -> Manifest:
        """A version with the same rows that remembers more."""
        known = self.manifest()
        return self._commit(known.version + 1, known.schema, known.places, {**known.meta, **meta})

    def _places_of(self, keys: DataFrame) -> set[str]:
        return {r["p"] for r in keys.select(self.place.alias("p")).distinct().collect()}  # as many as the table has places

    def _widened(self, known: T.StructType, new: T.StructType) -> T.StructType:
        have = {f.name: f for f in known}
        changed = [f.name for f in new if f.name in have and have[f.name].dataType != f.dataType]
        if changed:
            raise ValueError(f"schema changed: {changed}")
        newest = {f.name: f for f in new}
        return T.StructType([newest.get(f.name, f) for f in known] + [f for f in new if f.name not in have])

    def _write(self, rows: DataFrame, token: str, dealt: bool = False) -> dict[str, str]:
        """Write rows by place and return the sub-folder of each place. Large places are split into several files."""
        placed = rows.withColumn(PLACE, self.place)
        placed = placed if dealt else placed.hint("rebalance", F.col(PLACE))
        # nobody reads the folder before the manifest names it, so tasks may put their files in place themselves
        writer = placed.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.partitionBy(PLACE).parquet(f"{self.path}/data/{token}")
        plain = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return {plain(n.split("=", 1)[1]): n for n in self._names(f"data/{token}") if n.startswith(f"{PLACE}=")}

    def _commit(self, version: int, schema: T.StructType, places: dict[str, list[str]], meta: dict) -> Manifest:
        known = Manifest(version, schema, {p: f for p, f in sorted(places.items()) if f}, meta)
        self._save(f"versions/{version:06d}.json", known.text())
        self._clean()
        return known

    def _clean(self) -> None:
        """Remove versions beyond the newest ``keep`` and data no kept version names, also that of loads that died."""
        versions = self.versions()
        kept = versions[-self.keep :]
        used = set().union(*[self._folders(self.manifest(v)) for v in kept])
        for v in versions[: -self.keep]:
            self._delete(f"versions/{v:06d}.json")
        for token in self._names("data"):
            held = {f for f in used if f.startswith(f"{token}/")}
            if not held:
                self._delete(f"data/{token}")
                continue
            for name in self._names(f"data/{token}"):
                if name.startswith(f"{PLACE}=") and f"{token}/{name}" not in held:
                    self._delete(f"data/{token}/{name}")

    # --- files

    @staticmethod
    def _token() -> str:
        return uuid.uuid4().hex[:16]

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, fs = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _delete(self, name: str) -> None:
        path, fs = self._path(name)
        fs.delete(path, True)

    def _load(self, name: str) -> str:
        path, fs = self._path(name)
        jvm = self.spark._jvm
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(path), "UTF-8"))
        try:
            return reader.readLine()
        finally:
            reader.close()

    def _save(self, name: str, text: str) -> None:
        """Write under another name and rename: the file is there whole or not at all."""
        path, fs = self._path(name)
        if fs.exists(path):
            raise FileExistsError(f"{self.path}/{name}: another writer was faster")
        draft, _ = self._path(f"{name}.{self._token()}.draft")
        out = fs.create(draft)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if not fs.rename(draft, path):
            raise OSError(f"cannot commit {self.path}/{name}")
