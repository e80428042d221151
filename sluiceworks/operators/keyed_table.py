"""A table with one row per key, kept as Parquet and changed by upserts.

Layout, all below one path::

    data/table_version=<n>-<attempt>/key_bucket=<k>/*.parquet    written once, never changed
    manifests/<n>                                                JSON: every bucket's folder
    staged/<n>-<attempt>                                         the batch of a running merge

``key_bucket = pmod(xxhash64(keys), buckets)``. A merge reads and rewrites only the buckets
that occur in the batch, then publishes a manifest; a reader holds on to the manifest it
started with. Writers may overlap: each writes to folders of its own, and one whose version was
published by another meanwhile starts again from that version. There is no time travel.
Publishing needs a file system whose rename is atomic and never replaces a file.

Choose ``buckets`` for the size the table will have: about its bytes over 1 GB.
"""

from __future__ import annotations

import json
import math
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.functions.evolution import conform, merged_type
from sluiceworks.operators.key_filter import filter_bytes, key_filter, split_by_filter
from sluiceworks.operators.latest import latest_per_key
from sluiceworks.storage import SharedFiles

_BUCKET, _VERSION, _SLICE, _RANK = "key_bucket", "table_version", "_slice", "_rank"
_ATTEMPTS = 20  # at publishing a version, against other writers
_MOST_SMALL = 16  # surplus files of a bucket at which a merge also packs it
_KEY_OVERHEAD = 64  # bytes per key in a broadcast hash table beside the key's own



class KeyedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._files = SharedFiles(spark)

    # ---- definition -----------------------------------------------------------------

    @classmethod
    def create_if_absent(
        cls,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: list[str],
        buckets: int = 64,
    ) -> KeyedTable:
        """The table at ``path``; a new one starts empty with ``schema``."""
        table = cls(spark, path)
        if table._versions():
            return table
        missing = [k for k in keys if k not in schema.fieldNames()]
        if missing or not keys:
            raise ValueError(f"keys {keys} must be columns of the table")
        table._publish(
            {
                "version": 0,
                "keys": list(keys),
                "bucket_count": buckets,
                "schema": json.loads(schema.json()),
                "buckets": {},
                "applied": {},
            }
        )
        return table

    def _versions(self) -> list[int]:
        return [int(n) for n, _ in self._files.children(f"{self.path}/manifests")]

    def _manifest(self, version: int | None = None) -> dict:
        if version is None:
            versions = self._versions()
            if not versions:
                raise FileNotFoundError(f"no table at {self.path}")
            version = versions[-1]
        return json.loads(self._files.read_text(f"{self.path}/manifests/{version:012d}"))

    def _publish(self, manifest: dict) -> None:
        manifest["published_ms"] = int(time.time() * 1000)
        self._files.publish_text(
            f"{self.path}/manifests/{manifest['version']:012d}", json.dumps(manifest)
        )

    @property
    def version(self) -> int:
        return self._versions()[-1]

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(self._manifest()["schema"])

    # ---- reading --------------------------------------------------------------------

    def read(self) -> DataFrame:
        manifest = self._manifest()
        return self._scan(manifest, manifest["buckets"]).drop(_BUCKET)

    def _scan(self, manifest: dict, buckets) -> DataFrame:
        """Rows of some buckets, with the bucket number."""
        folders = {k: manifest["buckets"][k]["folder"] for k in buckets}
        return self._read(T.StructType.fromJson(manifest["schema"]), folders)

    def _read(self, schema: T.StructType, folders: dict[str, str]) -> DataFrame:
        """One scan over the given folder of each bucket, with one path per folder."""
        wanted = T.StructType(
            [T.StructField(f.name, f.dataType) for f in schema.fields]
            + [T.StructField(_BUCKET, T.IntegerType())]
        )
        if not folders:
            return self.spark.createDataFrame([], wanted)
        base = f"{self.path}/data"
        members: dict[str, list[str]] = {}
        for k, folder in folders.items():
            members.setdefault(folder, []).append(k)
        paths = [f"{base}/{folder}/{_BUCKET}={{{','.join(ks)}}}" for folder, ks in members.items()]
        reader = self.spark.read.schema(wanted).option("basePath", base)
        return reader.parquet(*paths).select(*_cols(wanted.names))

    # ---- merging --------------------------------------------------------------------

    def merge(
        self,
        updates: DataFrame,
        order_by: list[str],
        batch_id: int | None = None,
        source: str = "default",
        broadcast_bytes: int = 32 << 20,
        file_bytes: int = 256 << 20,
        most_filter_bytes: int = 256 << 20,
    ) -> bool:
        """Update the rows whose keys exist, insert the others. False for a replayed batch.

        Of several updates to one key the latest by ``order_by`` counts. The update's row
        replaces the old one, nulls included. Columns that are new in the updates join the
        table and are null in older rows; table columns that the updates lack keep their
        old values. A null in a key is an error. With ``batch_id`` a batch that this
        ``source`` has already applied is skipped.

        Up to ``broadcast_bytes`` of keys are broadcast themselves, beyond that a filter of them of up
        to ``most_filter_bytes``, see ``key_filter``: only rows that may be in the batch are shuffled.
        """
        for _ in range(_ATTEMPTS):
            attempt = uuid.uuid4().hex[:12]
            try:
                limits = (broadcast_bytes, file_bytes, most_filter_bytes)
                return self._try_merge(updates, order_by, batch_id, source, limits, attempt)
            except FileExistsError:  # another writer published this version first
                continue
            finally:
                self._files.delete(f"{self.path}/staged/{attempt}")
        raise TimeoutError(f"other writers published {_ATTEMPTS} versions of {self.path} meanwhile")

    def _try_merge(self, updates, order_by, batch_id, source, limits, attempt) -> bool:
        before = self._manifest()
        if batch_id is not None and before["applied"].get(source, -1) >= batch_id:
            return False
        keys = before["keys"]
        schema, updates, absent = _align(
            T.StructType.fromJson(before["schema"]), updates, keys, order_by
        )
        bucket = F.pmod(F.xxhash64(*_cols(keys)), F.lit(before["bucket_count"])).cast("int")
        given = [f for f in schema.fields if f.name not in absent]
        latest = latest_per_key(updates, keys, order_by).select(
            *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in given],
            bucket.alias(_BUCKET),
        )
        folder = f"{_VERSION}={before['version'] + 1}-{attempt}"
        if not before["buckets"]:
            self._first_load(latest, schema, absent, keys, folder)
        else:
            staged = f"{self.path}/staged/{attempt}"
            merged = self._merged(before, latest, schema, absent, staged, limits)
            if merged is None:  # an empty batch still counts as applied
                return self._finish(before, schema, {}, batch_id, source)
            self._write(merged.select(*_cols(schema.names), _BUCKET), folder)
        return self._finish(before, schema, self._sizes(folder), batch_id, source)

    def _first_load(self, latest, schema, absent, keys, folder) -> None:
        """Into an empty table: the rows go straight to their buckets."""
        kept = [F.lit(None).cast(schema[c].dataType).alias(c) for c in absent]
        rows = latest.select("*", *kept).select(*_cols(schema.names), _BUCKET)
        self._write(rows.hint("rebalance", _BUCKET), folder)
        written = self._read(schema, dict.fromkeys(self._sizes(folder), folder))
        if not written.where(_any_null(keys)).isEmpty():
            raise ValueError(f"null in a key column {keys}")

    def _merged(self, before, latest, schema, absent, staged, limits) -> DataFrame | None:
        """The new rows of every bucket in the batch.

        The deduplicated batch is written first, so that all later steps read the same
        rows, whatever happens to executors or to the source.
        """
        latest.write.parquet(staged)
        fresh = self.spark.read.schema(latest.schema).parquet(staged)
        broadcast_bytes, file_bytes, most_filter_bytes = limits
        keys = before["keys"]
        key_text = F.concat_ws("", *[c.cast("string") for c in _cols(keys)])
        arrived = (
            fresh.groupBy(_BUCKET)
            .agg(
                F.count("*").alias("n"),
                F.sum(F.octet_length(key_text)).alias("key_bytes"),
                F.max(_any_null(keys)).alias("null_key"),
            )
            .collect()
        )
        if not arrived:
            return None
        if any(r["null_key"] for r in arrived):
            raise ValueError(f"null in a key column {keys}")
        rows = {str(r[_BUCKET]): r["n"] for r in arrived}
        known = [k for k in rows if k in before["buckets"]]
        target = self._scan(dict(before, schema=json.loads(schema.json())), known)
        total = sum(rows.values())
        key_size = sum(r["key_bytes"] for r in arrived) + total * _KEY_OVERHEAD
        crowded = any(_small_files(before["buckets"][k], file_bytes) > _MOST_SMALL for k in known)
        if not absent and not crowded and key_size <= broadcast_bytes:
            # a small batch: the table's rows stay where the scan puts them
            tasks = min(len(rows), self.spark.sparkContext.defaultParallelism)
            stale = F.broadcast(fresh.select(*_cols(keys)))
            kept = target.join(stale, keys, "left_anti")
            return kept.unionByName(fresh.repartition(tasks, _BUCKET))
        row_bytes = self._files.size(staged)[1] / total
        sizes = {k: n * row_bytes for k, n in rows.items()}
        if not crowded and filter_bytes(total) <= most_filter_bytes:
            # the rows that surely stay are written where the scan puts them
            bits = key_filter(fresh, keys, total)
            touched, kept = split_by_filter(target, keys, bits, total)
            doubled = {k: 2 * size for k, size in sizes.items()}
            merged = self._one_shuffle(touched, fresh, keys, absent, doubled, file_bytes)
            return kept.unionByName(merged.select(*_cols(target.columns)))
        for k in known:
            sizes[k] += before["buckets"][k]["bytes"]
        return self._one_shuffle(target, fresh, keys, absent, sizes, file_bytes)

    def _finish(self, before, schema, changed, batch_id, source) -> bool:
        applied = dict(before["applied"])
        if batch_id is not None:
            applied[source] = batch_id
        self._publish(
            dict(
                before,
                version=before["version"] + 1,
                schema=json.loads(schema.json()),
                buckets={**before["buckets"], **changed},
                applied=applied,
            )
        )
        return True

    def _one_shuffle(self, target, fresh, keys, absent, sizes, file_bytes) -> DataFrame:
        """Both sides meet in one shuffle by bucket and slice, which is also the layout
        of the files to write. A key has at most two rows, so the window groups are tiny."""
        both = target.withColumn(_RANK, F.lit(0)).unionByName(
            fresh.withColumn(_RANK, F.lit(1)), allowMissingColumns=True
        )
        spread = self._by_slice(both, keys, sizes, file_bytes)
        w = Window.partitionBy(_BUCKET, _SLICE, *keys).orderBy(F.desc(_RANK))
        kept = [
            # the row after an update is the table's own row for the key
            F.when(F.col(_RANK) == 1, F.lead(c).over(w)).otherwise(F.col(c)).alias(c)
            for c in absent
        ]
        rest = [c for c in target.columns if c not in absent]
        return (
            spread.select(*_cols(rest), *kept, F.row_number().over(w).alias("_nth"))
            .where("_nth = 1")
            .drop("_nth")
        )

    def _by_slice(self, df, keys, sizes: dict[str, int], file_bytes: int) -> DataFrame:
        """Shuffle so that a task holds about one file's worth of one bucket.

        The slice count of a bucket follows from its size; the counts travel as a
        broadcast of one row per bucket.
        """
        slices = {int(k): max(1, math.ceil(size / file_bytes)) for k, size in sizes.items()}
        counts = self.spark.createDataFrame(
            list(slices.items()), f"{_BUCKET} int, _slices int"
        )
        # other bits of the hash than the bucket number uses
        position = F.shiftrightunsigned(F.xxhash64(*_cols(keys), F.lit(1)), 1)
        tasks = max(sum(slices.values()), self.spark.sparkContext.defaultParallelism)
        return (
            df.join(F.broadcast(counts), _BUCKET)
            .withColumn(_SLICE, (position % F.col("_slices")).cast("int"))
            .drop("_slices")
            .repartition(tasks, _BUCKET, _SLICE)
        )

    def _write(self, df: DataFrame, folder: str) -> None:
        df.write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{folder}")

    def _sizes(self, folder: str) -> dict[str, dict]:
        """Folder, file count and bytes of every bucket written in one go."""
        found: dict[str, dict] = {}
        for name, size in self._files.below(f"{self.path}/data/{folder}"):
            bucket, _, file = name.partition("/")
            if file.startswith("part-"):
                k = bucket.split("=")[1]
                entry = found.setdefault(k, {"folder": folder, "files": 0, "bytes": 0})
                entry["files"] += 1
                entry["bytes"] += size
        return found

    # ---- maintenance ----------------------------------------------------------------

    def files(self) -> int:
        return sum(b["files"] for b in self._manifest()["buckets"].values())

    def compact(self, target_bytes: int = 50 << 20) -> int:
        """Rewrite the buckets that have more files than their size calls for.

        The content stays the same. Returns the number of buckets rewritten.
        """
        for _ in range(_ATTEMPTS):
            before = self._manifest()
            due = {
                k: b["bytes"]
                for k, b in before["buckets"].items()
                if _small_files(b, target_bytes) > 0
            }
            if not due:
                return 0
            folder = f"{_VERSION}={before['version'] + 1}-{uuid.uuid4().hex[:12]}"
            rows = self._by_slice(self._scan(before, due), before["keys"], due, target_bytes)
            schema = T.StructType.fromJson(before["schema"])
            self._write(rows.select(*_cols(schema.names), _BUCKET), folder)
            try:
                self._finish(before, schema, self._sizes(folder), None, "")
                return len(due)
            except FileExistsError:  # a merge came first; its rows must be in the new files
                continue
        raise TimeoutError(f"other writers published {_ATTEMPTS} versions of {self.path} meanwhile")

    def vacuum(self, retention_hours: float = 168, force: bool = False) -> int:
        """Delete bucket folders that no reader from within the retention can need.

        Kept are the folders of the current manifest, of manifests that were replaced
        within the retention, and anything written within it. A retention below 24 hours
        needs ``force``. Returns the number of folders deleted.
        """
        if retention_hours < 24 and not force:
            raise ValueError("readers may still need these files; pass force=True if not")
        limit = int((time.time() - retention_hours * 3600) * 1000)
        versions = self._versions()
        needed: set[tuple[str, str]] = set()
        replaced_at = None
        expired = []
        for v in reversed(versions):
            manifest = self._manifest(v)
            if replaced_at is None or replaced_at >= limit:
                needed |= {(b["folder"], k) for k, b in manifest["buckets"].items()}
            else:
                expired.append(v)
            replaced_at = manifest["published_ms"]
        deleted = 0
        used = {folder for folder, _ in needed}
        for folder, modified in self._files.children(f"{self.path}/data"):
            place = f"{self.path}/data/{folder}"
            buckets = self._files.children(place, f"{_BUCKET}=*")
            if folder not in used and modified < limit and all(m < limit for _, m in buckets):
                self._files.delete(place)  # in one call, with the folder itself
                deleted += len(buckets)
                continue
            for name, written in buckets:
                if (folder, name.split("=")[1]) not in needed and written < limit:
                    self._files.delete(f"{place}/{name}")
                    deleted += 1
        for name, modified in self._files.children(f"{self.path}/staged"):
            if modified < limit:
                self._files.delete(f"{self.path}/staged/{name}")
        for v in expired:
            self._files.delete(f"{self.path}/manifests/{v:012d}")
        return deleted

    def folders(self) -> int:
        """Bucket folders in the table's place, live or not."""
        versions = [name for name, _ in self._files.children(f"{self.path}/data")]
        return sum(len(self._files.children(f"{self.path}/data/{v}", f"{_BUCKET}=*")) for v in versions)


def _cols(names) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _small_files(bucket: dict, file_bytes: int) -> int:
    """Files beyond those that the bucket's size calls for."""
    return bucket["files"] - max(1, math.ceil(bucket["bytes"] / file_bytes))


def _any_null(keys: list[str]) -> Column:
    found = F.lit(False)
    for key in _cols(keys):
        found = found | key.isNull()
    return found


def _align(
    target: T.StructType, updates: DataFrame, keys: list[str], order_by: list[str]
) -> tuple[T.StructType, DataFrame, list[str]]:
    """The schema after the merge, the updates under its names, and the columns they lack.

    Columns grow at any depth, see ``merged_type``; keys keep their type, which places their rows.
    """
    known = {f.name.lower(): f for f in target.fields}
    merged, added, renamed = {}, [], []
    for field in updates.schema.fields:
        old = known.get(field.name.lower())
        column = F.col(f"`{field.name}`")
        if old is None:
            added.append(T.StructField(field.name, field.dataType, True))
            renamed.append(column)
            continue
        kind = merged_type(old.dataType, field.dataType, old.name)
        if old.name in keys and kind != old.dataType:
            raise ValueError(f"key {old.name} is {old.dataType.simpleString()}, the updates' is wider")
        if kind != old.dataType:
            merged[old.name] = kind
        renamed.append(conform(column, field.dataType, kind).alias(old.name))
    target = T.StructType(
        [T.StructField(f.name, merged.get(f.name, f.dataType), f.nullable) for f in target.fields]
    )
    aligned = updates.select(*renamed)
    lacking = [k for k in [*keys, *order_by] if k not in aligned.columns]
    if lacking:
        raise ValueError(f"the updates lack {lacking}")
    reserved = {_BUCKET, _VERSION, _SLICE, _RANK, "_nth"} & set(aligned.columns)
    if reserved:
        raise ValueError(f"column names {sorted(reserved)} are taken by the table layout")
    absent = [f.name for f in target.fields if f.name not in aligned.columns]
    return T.StructType([*target.fields, *added]), aligned, absent
