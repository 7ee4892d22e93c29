"""Tables with upsert semantics, fed by micro-batches.

Each micro-batch writes only its own rows into a folder named after its batch id, and readers merge
the folders (see :mod:`footfall.operators.upsert`). A batch that is run again overwrites
its folder, so results do not depend on retries. Compaction folds the small folders into a base.

    <path>/delta/version=<batch id>
    <path>/base/version=<batch id>[/<partition>=…]

Only bases are cut by partition value: a micro-batch is small and should not leave a file for each of
its days. A table of point lookups is cut by a hash of its keys instead (``buckets``): a lookup opens the
buckets of the keys asked for, and Parquet's statistics on the sorted keys and a Bloom filter on
``bloom`` skip row groups inside. A folder counts once Spark's committer has put ``_SUCCESS`` into it. One query writes a table,
and table and query checkpoint are kept or dropped together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.operators.upsert import VERSION, merge_versions
from footfall.sinks.publish import file_system

BUCKET = "bucket"


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    schema: str
    mode: str
    keys: Sequence[str]
    values: Sequence[str] = ()
    group: Sequence[str] = ()
    partition: str | None = None
    compact_every: int = 50
    buckets: int = 0
    bloom: str | None = None

    def __post_init__(self) -> None:
        if self.buckets:
            object.__setattr__(self, "partition", BUCKET)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Apply one micro-batch. ``rows`` holds each key at most once."""
        self._save(rows, "delta", batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def read(
        self, upto: int | None = None, partitions: Sequence[str] | None = None
    ) -> DataFrame:
        """Merged rows, of all batches or of those up to ``upto``.

        ``partitions`` restricts the read to some values of the partition column.
        """
        bases = self._versions("base", upto)
        return self._merged(bases, self._deltas_after(bases, upto), partitions)

    def lookup(self, requests: DataFrame, upto: int | None = None) -> DataFrame:
        """The rows of the keys in ``requests``; of a bucketed table only their buckets are opened."""
        keys = requests.select(*self.keys)
        touched = None
        if self.buckets and self._versions("base", upto):
            found = keys.select(self._bucket().alias(BUCKET)).distinct().collect()
            touched = [row[0] for row in found]
        return self.read(upto, touched).join(keys, list(self.keys), "left_semi")

    def compact(self, batch_id: int) -> None:
        """Fold the deltas up to a batch into a base.

        Only partitions with new rows are rewritten; the others keep their earlier base folder.
        What an earlier base already covers is no longer needed, even for running the latest batch
        again, and is removed.
        """
        bases = self._versions("base", batch_id - 1)
        deltas = self._deltas_after(bases, batch_id)
        touched = None
        if self.partition:
            # Days or buckets with new rows since the last compaction.
            rows = self._load(deltas).select(self.partition).distinct().collect()
            touched = [row[0] for row in rows]
        self._save(self._merged(bases, deltas, touched), "base", batch_id)
        if bases:
            self._remove_superseded(bases)

    def _merged(
        self, bases: list[tuple[int, str]], deltas: list[str], partitions: Sequence[str] | None
    ) -> DataFrame:
        rows = self._load([*self._in_force(bases, partitions), *deltas])
        if partitions is not None and self.partition:
            rows = rows.filter(F.col(self.partition).isin(*partitions))
        return merge_versions(rows, self.mode, self.keys, self.values, self.group)

    def _in_force(
        self, bases: list[tuple[int, str]], partitions: Sequence[str] | None = None
    ) -> list[str]:
        """The latest base folder of every partition value, or of the wanted ones alone."""
        folders = {}
        wanted = None if partitions is None else {f"{self.partition}={p}" for p in partitions}
        for _, folder in bases:
            if self.partition:
                names = self._partitions(folder)
                folders.update({name: f"{folder}/{name}" for name in names
                                if wanted is None or name in wanted})
            else:
                folders[""] = folder
        return list(folders.values())

    def _deltas_after(self, bases: list[tuple[int, str]], upto: int | None) -> list[str]:
        done = bases[-1][0] if bases else -1
        return [folder for version, folder in self._versions("delta", upto) if version > done]

    def _remove_superseded(self, bases: list[tuple[int, str]]) -> None:
        for version, folder in self._versions("delta", bases[-1][0]):
            self._delete(folder)
        kept = set(self._in_force(bases))
        for _, folder in bases[:-1]:
            parts = [f"{folder}/{name}" for name in self._partitions(folder)]
            stale = [part for part in parts if part not in kept]
            if folder not in kept and len(stale) == len(parts):
                stale = [folder]
            for part in stale:
                self._delete(part)

    def _versions(self, kind: str, upto: int | None = None) -> list[tuple[int, str]]:
        """Committed folders, oldest first."""
        fs, pattern = file_system(self.spark, f"{self.path}/{kind}/{VERSION}=*/_SUCCESS")
        names = [s.getPath().getParent().getName() for s in fs.globStatus(pattern) or []]
        found = [(int(name.split("=")[1]), f"{self.path}/{kind}/{name}") for name in names]
        return sorted(v for v in found if upto is None or v[0] <= upto)

    def _partitions(self, folder: str) -> list[str]:
        return [n for n in self._list(folder) if n.startswith(f"{self.partition}=")]

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _struct(self) -> T.StructType:
        return T.StructType.fromDDL(f"{self.schema}, {VERSION} BIGINT")

    def _save(self, rows: DataFrame, kind: str, batch_id: int) -> None:
        columns = [f.name for f in self._struct() if f.name != VERSION]
        cut_by = [self.partition] if self.partition and kind == "base" else []
        rows = rows.select(*columns)
        if self.buckets and cut_by:
            rows = rows.withColumn(BUCKET, self._bucket())
        # Few files of even size; AQE splits a partition value that is large.
        rows = rows.hint("rebalance", *cut_by)
        if self.buckets and cut_by:
            rows = rows.sortWithinPartitions(BUCKET, *self.keys)
        writer = rows.write
        if self.bloom and cut_by:
            writer = writer.option(f"parquet.bloom.filter.enabled#{self.bloom}", "true")
        (
            writer.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*cut_by)
            .parquet(f"{self.path}/{kind}/{VERSION}={batch_id}")
        )

    def _load(self, folders: list[str]) -> DataFrame:
        if not folders:
            struct = self._struct()
            return self.spark.createDataFrame(
                [], struct.add(BUCKET, T.IntegerType()) if self.buckets else struct
            )
        frames = []
        for kind in ("base", "delta"):
            paths = [f for f in folders if f.startswith(f"{self.path}/{kind}/")]
            if paths:
                struct = self._struct()
                if self.buckets and kind == "base":
                    struct = struct.add(BUCKET, T.IntegerType())
                reader = self.spark.read.schema(struct)
                frame = reader.option("basePath", f"{self.path}/{kind}").parquet(*paths)
                if self.buckets and kind == "delta":
                    frame = frame.withColumn(BUCKET, self._bucket())
                frames.append(frame)
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def _list(self, folder: str) -> list[str]:
        fs, path = file_system(self.spark, folder)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _delete(self, folder: str) -> None:
        fs, path = file_system(self.spark, folder)
        fs.delete(path, True)
