"""Lake tables: catalog tables, and tables that keep their snapshots.

A snapshot table is a folder with ``data`` partitioned by ``snapshot_id`` and a ``log``
with one entry for each commit. Data are written first and logged last, and the next id is
the first after the last logged one that nobody has claimed. A claim is a file that only
one writer can create, so two writers never share a number; what a failed job left behind
under its number is never read. Any number of readers and writers, on file systems that
create a file only once (HDFS, local and shared mounts). Where creating is a check and a
write, as on plain object stores, only one writer may commit at a time.

An overwrite covers the numbers below its own and hides their rows. A compaction covers less:
it stops before the first number that a writer may still be at work on, so what is appended
meanwhile stays, whether its number is lower or higher.
"""

from __future__ import annotations

import datetime as dt

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from citemill import schemas
from citemill.functions import vectors as vec
from citemill.functions.joins import same_key

# Names of the database and its tables.
DATABASE = "rag_data_lake"
TABLES = {
    "raw_documents": (schemas.RAW_DOCUMENTS, ("ingestion_date",)),
    "document_chunks": (schemas.DOCUMENT_CHUNKS, ()),
    "embeddings_metadata": (schemas.EMBEDDINGS_METADATA, ()),
}
# A claimed number that has no log entry after so long is taken as given up.
GIVEN_UP = dt.timedelta(days=1)


def create_tables(spark: SparkSession, database: str = DATABASE, location: str | None = None):
    """Create the database and its tables unless they exist; returns their names.

    Chunks are not partitioned by document, as that would make one folder for each.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for name, (schema, partitions) in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{by}")
    return sorted(t.name for t in spark.catalog.listTables(database))


def append(rows: DataFrame, table: str) -> None:
    """Append by column name; columns may come in any order but must all be there."""
    columns = rows.sparkSession.table(table).columns
    rows.select(*columns).write.mode("append").insertInto(table)


def overwrite(rows: DataFrame, table: str) -> None:
    """Replace all rows of the table, again by column name."""
    columns = rows.sparkSession.table(table).columns
    rows.select(*columns).write.mode("overwrite").insertInto(table)


def latest_snapshot(log: DataFrame) -> DataFrame:
    """One row: the snapshot committed last, the higher id if two share a time."""
    last = F.max(F.struct("committed_at", "snapshot_id", "operation", "added_rows"))
    return log.agg(last.alias("last")).select(
        "last.snapshot_id", "last.committed_at", "last.operation", "last.added_rows"
    )


def _covered(log: DataFrame) -> Column:
    """The last number whose rows an entry hides; null if it is no overwrite."""
    own = F.col("covers") if "covers" in log.columns else F.lit(None).cast("bigint")
    return F.when(F.col("operation") == "overwrite", F.coalesce(own, F.col("snapshot_id") - 1))


def visible(log: DataFrame, at: dt.datetime | str | None = None) -> DataFrame:
    """Log entries of the snapshots seen at ``at``, with their place in time as ``nth``.

    These are the entries committed at or before that time whose numbers no overwrite among
    them covers. ``nth`` is the number itself, for an overwrite the last number it covers; of
    overwrites that cover as much as each other, the first is shown.
    """
    seen = log
    if at is not None:
        seen = log.filter(F.col("committed_at") <= F.lit(at).cast("timestamp"))
    covers, number = _covered(seen), F.col("snapshot_id")
    base = seen.agg(F.max(F.struct(covers.alias("covers"), (-number).alias("first"))).alias("base")).select("base").scalar()
    covered = F.when(covers.isNotNull(), number == -base["first"]).otherwise(number > F.coalesce(base["covers"], F.lit(0)))
    return seen.filter(covered).withColumn("nth", F.coalesce(covers, number))


def as_of(rows: DataFrame, log: DataFrame, at: dt.datetime | str | None = None) -> DataFrame:
    """Rows of a table as they were at ``at``: those of logged snapshots seen then.

    A filter on ``snapshot_id`` that prunes partitions, and a semi-join with the entries.
    A time before the first commit is an error, raised when the rows are read.
    """
    seen = visible(log, at)
    none = F.raise_error(F.lit(f"no snapshot at or before {at}"))
    bounds = seen.agg(F.min("snapshot_id").alias("base"), F.max("snapshot_id").alias("last"))
    found = F.when(F.col("last").isNull(), none).otherwise(F.struct("base", "last"))
    bounds = bounds.select(found).scalar()
    snapshot = F.col("snapshot_id")
    ranged = rows.filter((snapshot >= bounds["base"]) & (snapshot <= bounds["last"]))
    return ranged.join(seen.select("snapshot_id"), "snapshot_id", "left_semi").select(*rows.columns)


def current(rows: DataFrame, key: str = "doc_id", base: int | None = None) -> DataFrame:
    """For each key only the rows of its newest snapshot.

    What is joined to the rows is one small row for each key that came with a later
    snapshot than ``base``, the first one there is. Given ``base``, only the later
    snapshots are read for that, and if they are small Spark broadcasts the result, so
    that neither the keys of the base nor the rows themselves are shuffled.
    """
    later = rows if base is None else rows.filter(F.col("snapshot_id") > base)
    newest = later.groupBy(F.col(key).alias("newest_key")).agg(
        F.max("snapshot_id").alias("newest_snapshot")
    )
    outdated = same_key(key, "newest_key") & (
        F.col("snapshot_id") < F.col("newest_snapshot")
    )
    return rows.join(newest, outdated, "left_anti")


class SnapshotTable:
    """A table under ``folder`` that keeps its history; made, without rows, unless it is there.

    ``properties`` are stored when the table is made. Whoever opens it later gets those that
    are stored, and is refused if they differ from what is asked for.

    Columns ``packed``, vectors of floats without nulls, are kept as bytes, since Spark takes far
    longer to write or read the elements of a list. A table made otherwise stays as it is, and
    readers get lists unless they ask for the bytes.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: T.StructType,
        properties: dict[str, str] | None = None,
        packed: tuple[str, ...] = (),
    ) -> None:
        self.spark, self.schema = spark, schema
        folder = folder.rstrip("/")
        self._data, self._log, self._claims = f"{folder}/data", f"{folder}/log", f"{folder}/claims"
        asked = {name: str(value) for name, value in (properties or {}).items()}
        for made, kind, lines in (
            (f"{self._data}/snapshot_id=0", self._kept_as(packed), []),
            (f"{self._log}/entry=0", schemas.SNAPSHOT_LOG, []),
            (f"{folder}/properties", schemas.PROPERTIES, list((asked | ({"packed": ",".join(packed)} if packed else {})).items())),
        ):
            spark.createDataFrame(lines, kind).coalesce(1).write.mode("ignore").parquet(made)
        stored = spark.read.schema(schemas.PROPERTIES).parquet(f"{folder}/properties")
        self.properties = {row["name"]: row["value"] for row in stored.collect()}
        self.packed = tuple(filter(None, self.properties.pop("packed", "").split(",")))
        self.kept = self._kept_as(self.packed)
        for name, value in asked.items():
            if self.properties.get(name) != value:
                raise ValueError(f"{name} is {self.properties.get(name)}, not {value}")

    def _kept_as(self, packed: tuple[str, ...]) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.BinaryType()) if f.name in packed else f for f in self.schema])

    def _given(self, rows: DataFrame, packed: bool) -> DataFrame:
        return rows if packed or not self.packed else rows.withColumns({c: vec.unpack(F.col(c)) for c in self.packed})

    def log(self) -> DataFrame:
        entries = self.spark.read.schema(schemas.SNAPSHOT_LOG).parquet(self._log)
        return entries.select(*schemas.SNAPSHOT_LOG.names)

    def rows(self, packed: bool = False) -> DataFrame:
        """Everything stored, also what no snapshot shows any more."""
        number = T.StructField("snapshot_id", T.LongType())
        schema = T.StructType([*self.kept.fields, number])
        return self._given(self.spark.read.schema(schema).parquet(self._data), packed)

    def _seen(self, at: dt.datetime | str | None) -> list:
        """Entries of the snapshots seen at ``at``: ``snapshot_id, nth``, one for each commit."""
        seen = visible(self.log(), at).select("snapshot_id", "nth").collect()
        if not seen and at is not None:
            raise ValueError(f"no snapshot at or before {at}")
        return sorted(seen, key=lambda entry: entry["nth"])

    def _rows_of(self, seen: list) -> DataFrame:
        """Rows of some snapshots; no other folder is listed or read."""
        if not seen:
            return self.rows(packed=True).filter(F.lit(False))
        schema = T.StructType([*self.kept.fields, T.StructField("snapshot_id", T.LongType())])
        places = [f"{self._data}/snapshot_id={entry['snapshot_id']}" for entry in seen]
        return self.spark.read.schema(schema).option("basePath", self._data).parquet(*places)

    def _store(self):
        paths = self.spark._jvm.org.apache.hadoop.fs
        return paths, paths.Path(self._claims).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _claim(self) -> int:
        """The next number, claimed by a file that cannot be created twice."""
        paths, store = self._store()

        def taken(number: int) -> bool:
            try:
                return not store.createNewFile(paths.Path(f"{self._claims}/{number}"))
            except Py4JJavaError as error:
                # Another writer came between the look and the creation.
                if "FileAlreadyExistsException" in str(error.java_exception):
                    return True
                raise

        number = (self.log().agg(F.max("snapshot_id")).first()[0] or 0) + 1
        while taken(number):
            number += 1
        return number

    def _settled(self, log: DataFrame, below: int, given_up: dt.timedelta) -> int:
        """The last number under ``below`` up to which each has its entry or is given up."""
        paths, store = self._store()
        now = dt.datetime.now().timestamp() * 1000
        young = {
            int(claim.getPath().getName())
            for claim in store.listStatus(paths.Path(self._claims))
            if now - claim.getModificationTime() < given_up.total_seconds() * 1000
        }
        logged = log.filter(F.col("snapshot_id") < below).select("snapshot_id").collect()
        open_ = {n for n in young if n < below} - {row["snapshot_id"] for row in logged}
        return min(open_, default=below) - 1

    def read(self, at: dt.datetime | str | None = None) -> DataFrame:
        """All visible rows, those of later snapshots beside those they outdate."""
        return self._given(self._rows_of(self._seen(at)), False)

    def current(self, at: dt.datetime | str | None = None, key: str = "doc_id", packed: bool = False) -> DataFrame:
        """Visible rows without those a later snapshot outdates."""
        return self._given(self._current(self._seen(at), key), packed)

    def _current(self, seen: list, key: str) -> DataFrame:
        rows = self._rows_of(seen)
        if len(seen) < 2:
            return rows
        own, number = seen[0]["snapshot_id"], F.col("snapshot_id")
        if own < min(entry["snapshot_id"] for entry in seen[1:]):
            return current(rows, key, own)
        # A compaction's number is higher than those of appends that came beside it.
        placed = rows.withColumn("snapshot_id", F.when(number == own, F.lit(0).cast("bigint")).otherwise(number))
        kept = current(placed, key, 0)
        return kept.withColumn("snapshot_id", F.when(number == 0, F.lit(own)).otherwise(number))

    def commit(
        self,
        rows: DataFrame,
        operation: str = "append",
        at: dt.datetime | None = None,
        stream_id: str | None = None,
        batch_id: int | None = None,
    ) -> int | None:
        """Write ``rows`` as the next snapshot and return its id.

        A batch of a stream that is already in the log is not written again.
        """
        if operation not in ("append", "overwrite"):
            raise ValueError(operation)
        log = self.log()
        if stream_id is not None:
            same = (F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id)
            if not log.filter(same).isEmpty():
                return None
        return self._write(rows, self._claim(), operation, at, stream_id, batch_id)

    def _write(self, rows, snapshot, operation, at=None, stream_id=None, batch_id=None, covers=None) -> int:
        place = f"{self._data}/snapshot_id={snapshot}"
        lists = [c for c in self.packed if rows.schema[c].dataType != T.BinaryType()]
        rows = rows.withColumns({c: vec.pack(F.col(c).cast("array<float>")) for c in lists})
        rows.select(*self.schema.names).write.mode("overwrite").parquet(place)
        added = self.spark.read.schema(self.kept).parquet(place).count()
        at = at or dt.datetime.now(dt.timezone.utc)
        entry = [(snapshot, at, operation, added, stream_id, batch_id, covers)]
        line = self.spark.createDataFrame(entry, schemas.SNAPSHOT_LOG)
        # A folder of its own, as writers that append to one folder disturb each other.
        line.coalesce(1).write.parquet(f"{self._log}/entry={snapshot}")
        return snapshot

    def compact(
        self, key: str = "doc_id", at: dt.datetime | None = None, given_up: dt.timedelta = GIVEN_UP
    ) -> int:
        """Rewrite the current rows as one overwriting snapshot.

        Snapshots that other writers add meanwhile are neither merged nor hidden. Writers
        take no longer than ``given_up`` for a commit.
        """
        snapshot = self._claim()
        log = self.log()
        covers = self._settled(log, snapshot, given_up)
        merged = visible(log.filter(F.col("snapshot_id") <= covers)).select("snapshot_id", "nth").collect()
        rows = self._current(sorted(merged, key=lambda entry: entry["nth"]), key)
        return self._write(rows, snapshot, "overwrite", at, covers=covers)
