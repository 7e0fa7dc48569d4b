"""A versioned table store on plain Parquet: layers of appended rows, one manifest per version.

Layout below the root folder::

    data/<table>/<run>/part-*.parquet      rows of one run, immutable
    replaced/<run>/part-*.parquet          ids whose older rows that run replaced
    manifests/<version>.json               the layers of each table, oldest first

An upsert writes the new rows and the ids that they replace, nothing else: its cost is that of the change.  A read keeps a
layer's rows whose id no later layer replaces (one join with the ids, which Catalyst broadcasts while they are few).
:meth:`Store.fold` joins layers again, newest first, as long as that at most triples what is written.

All tables of a run become visible together
when the next manifest is created (create without overwrite, so a second writer fails
instead of losing data).  A crash before that leaves the old version in place.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


class Published(RuntimeError):
    """Another writer has published the version."""


class Files:
    """The few file operations a manifest needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)
        self._io = jvm.org.apache.commons.io.IOUtils
        self._utf8 = jvm.java.nio.charset.StandardCharsets.UTF_8

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def size(self, folder: str) -> int:
        path = self._path(folder)
        return self._fs.getContentSummary(path).getLength() if self._fs.exists(path) else 0

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._io.toString(stream, self._utf8)
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Make the file appear whole, and only if there is none of this name: of racing writers one succeeds.

        Written beside first.  Then, in a local folder, linked (a link is never made over a file); elsewhere renamed without
        overwriting, which the file system itself must do as one step, as HDFS does.
        """
        target, side = self._path(name), self._path(f"{name}.{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(side, False)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        try:
            if self._fs.getScheme() == "file":
                nio, none = self._jvm.java.nio.file, self._gateway.new_array(self._jvm.java.lang.String, 0)
                nio.Files.createLink(*(nio.Paths.get(p.toUri().getPath(), none) for p in (target, side)))
                self._fs.delete(side, False)
            else:
                options = self._jvm.org.apache.hadoop.fs.Options.Rename
                no_overwrite = self._gateway.new_array(options, 1)
                no_overwrite[0] = options.NONE
                self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(side, target, no_overwrite)
        except Py4JJavaError as e:
            self._fs.delete(side, False)
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            raise Published(f"another writer has published {name}") from None


class Store:
    def __init__(self, spark: SparkSession, root: str, fold_after: int = 8):
        self.spark, self.root, self.fold_after = spark, root.rstrip("/"), fold_after
        self.files = Files(spark, self.root)

    # ---- versions ----------------------------------------------------------------

    def version(self) -> int:
        names = [n[:-5] for n in self.files.names(f"{self.root}/manifests") if n.endswith(".json")]
        return max((int(n) for n in names), default=0)

    def _manifest(self, version: int | None = None) -> dict:
        v = self.version() if version is None else version
        return json.loads(self.files.read(f"{self.root}/manifests/{v}.json")) if v else {"tables": {}, "batches": {}}

    def tables(self) -> list[str]:
        return sorted(self._manifest()["tables"])

    def last_batch(self, stream: str) -> int:
        """Number of the last batch of a stream that was published; -1 for none."""
        return self._manifest()["batches"].get(stream, -1)

    # ---- reading -----------------------------------------------------------------

    def read(self, table: str, schema: T.StructType | str | None = None) -> DataFrame:
        """Current rows of a table; an absent table is empty (then ``schema`` is needed).

        ``schema`` may hold more columns than are stored: they come back NULL.
        """
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        entry = self._manifest()["tables"].get(table)
        stored = T.StructType.fromJson(entry["schema"]) if entry else None
        names = wanted or stored
        if names is None:
            raise ValueError(f"table {table} does not exist and no schema was given")
        if not entry or not entry["layers"]:
            return self.spark.createDataFrame([], names)
        rows = self._rows(table, entry)
        have = set(rows.columns)
        return rows.select(*[F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in names.fields])

    def _rows(self, table: str, entry: dict, first: int = 0) -> DataFrame:
        """Rows of the layers from ``first`` on that no later layer replaces."""
        layers, key = entry["layers"], entry["key"]
        schema = _nullable(T.StructType.fromJson(entry["schema"]))
        parts = [self.spark.read.schema(schema).parquet(f"{self.root}/data/{table}/{layer['run']}") for layer in layers[first:]]
        if len(parts) == 1:
            return parts[0]
        older = None
        for k, part in enumerate(parts[:-1], first):
            numbered = part.withColumn("#layer", F.lit(k))
            older = numbered if older is None else older.unionByName(numbered)
        latest = self._replaced(layers, first + 1).groupBy("#id").agg(F.max("#replaced").alias("#replaced"))
        kept = older.join(latest, F.col(f"`{key}`") == F.col("#id"), "left").where(F.col("#replaced").isNull() | (F.col("#layer") >= F.col("#replaced")))
        return kept.select(*[f"`{f.name}`" for f in schema.fields]).unionByName(parts[-1])

    def _replaced(self, layers: list[dict], first: int) -> DataFrame:
        """(#id, #replaced): the ids that the layers from ``first`` on replaced, with the layer's number."""
        out = None
        for k, layer in enumerate(layers[first:], first):
            ids = self.spark.read.parquet(f"{self.root}/replaced/{layer['replaced']}").select(F.col("id").alias("#id"), F.lit(k).alias("#replaced"))
            out = ids if out is None else out.unionByName(ids)
        return out

    # ---- writing -----------------------------------------------------------------

    def begin(self) -> "Change":
        return Change(self)

    def fold(self) -> int | None:
        """Join the newest layers of each table that has more than ``fold_after``; the new version, or None.

        A layer is taken in while it is at most twice as large as the newer ones together, so a large old layer is rewritten
        only when as much has changed.  If another writer publishes meanwhile nothing is done.
        """
        change = self.begin()
        for table, entry in change.manifest["tables"].items():
            if len(entry["layers"]) > self.fold_after:
                change.join_layers(table)
        if change.unchanged:
            return None
        try:
            return change.publish()
        except Published:
            return None


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


class Change:
    """The writes of one run.  Nothing is visible before :meth:`publish`."""

    def __init__(self, store: Store):
        self.store = store
        self.base = store.version()
        self.manifest = store._manifest(self.base)
        self.run = uuid.uuid4().hex
        self.unchanged = True

    def _write(self, rows: DataFrame, table: str, key: str) -> dict:
        """Write rows as one layer."""
        path = f"{self.store.root}/data/{table}/{self.run}"
        # The rebalance gathers the rows of near ids but splits an id that holds too many.
        rows.hint("rebalance", F.col(f"`{key}`")).sortWithinPartitions(f"`{key}`").write.mode("overwrite").parquet(path)
        self.unchanged = False
        return {"run": self.run, "replaced": None, "bytes": self.store.files.size(path)}

    def replaced(self, ids: DataFrame) -> str:
        """Write ids (the first column) once for all tables whose rows a run replaces; "" if there are none."""
        name = f"{self.run}-{uuid.uuid4().hex[:8]}"
        path = f"{self.store.root}/replaced/{name}"
        ids.select(F.col(ids.columns[0]).alias("id")).distinct().write.parquet(path)
        return "" if self.store.spark.read.parquet(path).isEmpty() else name

    def replace(self, table: str, rows: DataFrame, key: str) -> None:
        """The whole table becomes ``rows``."""
        layer = self._write(rows, table, key)
        self.manifest["tables"][table] = {"schema": _nullable(rows.schema).jsonValue(), "key": key, "layers": [layer]}

    def writes(self, table: str, replaced: str) -> bool:
        """Whether an upsert for these ids (see :meth:`replaced`) writes anything."""
        return bool(replaced) or not self._layers(table)

    def upsert(self, table: str, rows: DataFrame, routed_ids: DataFrame, key: str, replaced: str | None = None) -> None:
        """Replace everything stored for the routed ids by ``rows``.

        ``replaced`` names the ids if :meth:`replaced` has written them.  Ids of new records may be
        among them, so a run that crashed before publishing can simply be repeated.
        """
        entry = {"schema": self._merged_schema(table, rows.schema).jsonValue(), "key": key, "layers": self._layers(table)}
        if entry["layers"]:
            replaced = self.replaced(routed_ids) if replaced is None else replaced
            if replaced:
                entry["layers"].append(self._write(rows, table, key) | {"replaced": replaced})
        else:
            entry["layers"].append(self._write(rows, table, key))
        self.manifest["tables"][table] = entry

    def join_layers(self, table: str) -> None:
        """The newest layers as one (see :meth:`Store.fold`)."""
        store, entry = self.store, self.manifest["tables"][table]
        layers = entry["layers"]
        first, size = len(layers) - 1, layers[-1]["bytes"]
        while first > 0 and (layers[first - 1]["bytes"] <= 2 * size or first == len(layers) - 1):
            first -= 1
            size += layers[first]["bytes"]
        joined = self._write(store._rows(table, entry, first), table, entry["key"])
        if first:
            joined["replaced"] = self.replaced(store._replaced(layers, first))
        self.manifest["tables"][table] = entry | {"layers": layers[:first] + [joined]}

    def _layers(self, table: str) -> list[dict]:
        return list(self.manifest["tables"].get(table, {"layers": []})["layers"])

    def _merged_schema(self, table: str, incoming: T.StructType) -> T.StructType:
        entry = self.manifest["tables"].get(table)
        fields = list(T.StructType.fromJson(entry["schema"]).fields) if entry else []
        have = {f.name for f in fields}
        return _nullable(T.StructType(fields + [f for f in incoming.fields if f.name not in have]))

    def publish(self, stream: str | None = None, batch: int = -1) -> int:
        """Make the writes visible; with a stream's batch its number becomes known in the same step."""
        if stream is not None:
            self.manifest["batches"][stream] = batch
        version = self.base + 1
        self.store.files.publish(f"{self.store.root}/manifests/{version}.json", json.dumps(self.manifest))
        return version
