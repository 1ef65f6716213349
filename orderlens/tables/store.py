"""Output tables: creation (O-08), hour partitioning (O-09), idempotent
commits, as-of reads (O-60), commit listing (O-61) and schema evolution
(O-64); expiry (O-62) and compaction (O-63) where the table format has them.

Two providers:

* ``parquet`` (default, portable): a table is a folder under the shared
  root (``spark.checkpoint.dir`` unless given), partitioned by ``event_hour``
  ('yyyy-MM-dd-HH' of the table's time column) and within it by ``commit``
  (writer and micro-batch), so a filter on ``event_hour`` prunes before
  any other folder is listed. Rows carry ``committed_at``. Every commit, an
  empty one too, has one row (id, time, rows) in a commit log beside the
  table: listing commits opens no data file, and as-of reads take the commits
  they may see from it. A commit that is written again (a retried
  micro-batch) first removes what its earlier attempt left.
* ``iceberg``: the same tables through an Iceberg catalog (hours()
  partitioning, snapshots, ``TIMESTAMP AS OF``, stored procedures) when its
  runtime is on the class path; the statements are built here and run by
  Spark SQL. An append names its commit in the snapshot's summary, where a
  retry finds it.

A NULL in a column that a table declares NOT NULL fails the write.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schemas as S
from orderlens.functions.columns import as_of_column
from orderlens.session import checkpoint_root
from orderlens.tables.sinks import not_null_violation

HOUR_COLUMN = "event_hour"
COMMIT_COLUMN = "commit"
COMMITTED_AT = "committed_at"
HOUR_PARTS = 4  # tasks that share an hour of a micro-batch
COMMIT_PROPERTY = "orderlens.commit"  # of an Iceberg snapshot


def commit_id(source: str, batch_id: int) -> str:
    """Commit folder name: writer name + zero-padded micro-batch id, so
    commits of one writer sort in batch order and writers never collide."""
    return f"{source}-{int(batch_id):012d}"


def hour_key(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd-HH")


@dataclass
class TableStore:
    spark: SparkSession
    root: str | None = None
    provider: str = "parquet"
    catalog: str = "orders"

    def __post_init__(self):
        if self.root is None and self.provider == "parquet":
            self.root = f"{checkpoint_root(self.spark)}/tables"

    # -- naming ------------------------------------------------------------
    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def qualified(self, table: str) -> str:
        return f"{self.catalog}.default.{table}"

    # -- O-08 / O-09 -------------------------------------------------------
    def ddl(self, table: str) -> str:
        """Iceberg's CREATE TABLE statement (idempotent) with NOT NULL columns,
        hour partitioning and the retention property of the table."""
        schema, ts_col = S.TABLES[table]
        cols = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
        )
        props = {"write.metadata.delete-after-commit.enabled": "true",
                 "write.metadata.previous-versions-max": "5"}
        if table == "order_events":
            props["history.expire.max-snapshot-age-ms"] = str(7 * 86400 * 1000)
        props_sql = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
        return (f"CREATE TABLE IF NOT EXISTS {self.qualified(table)} ({cols}) USING iceberg "
                f"PARTITIONED BY (hours({ts_col})) TBLPROPERTIES ({props_sql})")

    def create_tables(self, tables=tuple(S.TABLES)) -> dict[str, str]:
        """Create every output table if missing; returns name -> location.
        Parquet: the folder, so that ``read`` works before the first commit
        (a catalog table would not list the partitions written later)."""
        out = {}
        for t in tables:
            if self.provider == "iceberg":
                self.spark.sql(self.ddl(t))
                out[t] = self.qualified(t)
                continue
            empty = self.spark.createDataFrame([], S.TABLES[t][0]).withColumns({HOUR_COLUMN: F.lit(""), COMMIT_COLUMN: F.lit("")})
            empty.write.mode("ignore").partitionBy(HOUR_COLUMN, COMMIT_COLUMN).parquet(self.path(t))  # no rows, no files
            out[t] = self.path(t)
        return out

    # -- writes ------------------------------------------------------------
    def write(self, table: str, rows: DataFrame, source: str, batch_id: int, committed_at=None) -> int:
        """Append one commit. Rows must already have the table's columns; a
        NULL in a NOT NULL column fails the write before anything counts.
        Re-running the same (source, batch_id) replaces that commit. Returns
        its number of rows, observed by the tasks that write."""
        _, ts_col = S.TABLES[table]
        schema = self.schema(table)
        undeclared = sorted(set(rows.columns) - set(schema.fieldNames()))
        if undeclared and self.provider != "iceberg":
            raise ValueError(f"{table} has no column {', '.join(undeclared)}: add_column() declares it")
        for f in schema.fields:
            if f.name not in rows.columns and f.nullable:
                rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
        key = commit_id(source, batch_id)
        if self.provider == "iceberg":
            made = self.spark.sql(f"SELECT 1 FROM {self.qualified(table)}.snapshots WHERE summary['{COMMIT_PROPERTY}'] = '{key}'")
            if not made.isEmpty():
                return rows.count()
            counted = Observation()
            rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
            rows.writeTo(self.qualified(table)).option(f"snapshot-property.{COMMIT_PROPERTY}", key).append()
            return counted.get["rows"]
        if committed_at is None:
            committed_at = dt.datetime.now(dt.timezone.utc)  # of this commit, on its rows and in the log
        stamp = as_of_column(committed_at).cast("timestamp")
        refused = F.raise_error(F.lit(f"{table}: NULL in a column declared NOT NULL"))
        hour = F.when(not_null_violation(schema), refused.cast("string")).otherwise(hour_key(ts_col))
        out = rows.select(*schema.fieldNames()).withColumns(
            {COMMITTED_AT: stamp, HOUR_COLUMN: hour, COMMIT_COLUMN: F.lit(key)})
        # Rows are dealt by hour, so a commit has few files; nothing is sampled.
        # AQE splits a hot hour into parts of its advisory size. A streaming
        # micro-batch plans without AQE: there an hour has a fixed few parts.
        if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            out = out.hint("rebalance", HOUR_COLUMN)
        else:
            out = out.repartition(HOUR_COLUMN, F.pmod(F.xxhash64(ts_col), F.lit(HOUR_PARTS)))
        counted = Observation()
        self._begin_commit(table, key)
        # Dynamic overwrite touches the folders of this commit only and stages
        # each job's files apart, so writers of one table can commit at once.
        (out.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(HOUR_COLUMN, COMMIT_COLUMN).parquet(self.path(table)))
        entry = self.spark.range(1).select(stamp.alias(COMMITTED_AT), F.lit(counted.get["rows"]).cast("long").alias("rows"))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self._commits_path(table)}/{COMMIT_COLUMN}={key}")
        return counted.get["rows"]

    def _begin_commit(self, table: str, key: str) -> None:
        """Note that the commit is being written. Where it was begun before,
        its rows are removed first: the folders of one commit, one an hour."""
        fs, begun = self._file_system(f"{self._commits_path(table)}/{COMMIT_COLUMN}={key}")
        if fs.exists(begun):
            _, every = self._file_system(f"{self.path(table)}/{HOUR_COLUMN}=*/{COMMIT_COLUMN}={key}")
            for found in fs.globStatus(every) or []:
                fs.delete(found.getPath(), True)
        fs.mkdirs(begun)

    def _file_system(self, path: str):
        """Hadoop's file system of ``path``, and the path as it takes it."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    # -- reads -------------------------------------------------------------
    def read(self, table: str) -> DataFrame:
        """The table's rows (all commits); rows written before a column was
        added read NULL there (O-64)."""
        if self.provider == "iceberg":
            return self.spark.table(self.qualified(table))
        full = T.StructType(self.schema(table).fields + [
            T.StructField(COMMITTED_AT, T.TimestampType()),
            T.StructField(HOUR_COLUMN, T.StringType()),
            T.StructField(COMMIT_COLUMN, T.StringType()),
        ])
        reader = self.spark.read.option("basePath", self.path(table))
        return reader.schema(full).parquet(self.path(table))

    def read_as_of(self, table: str, timestamp=None, commit: str | None = None) -> DataFrame:
        """O-60: the table as it was at ``timestamp`` (rows committed at or
        before it) or as it was when commit ``commit`` was made, whichever writers
        committed before. Tables are append-only, so the commits the log
        lists up to then are exact; joined on the partition column, they
        prune the folders that are read."""
        if self.provider == "iceberg":
            if commit is not None:
                return self.spark.sql(f"SELECT * FROM {self.qualified(table)} VERSION AS OF {int(commit)}")
            return self.spark.sql(f"SELECT * FROM {self.qualified(table)} TIMESTAMP AS OF '{timestamp}'")
        log = self.snapshots(table)
        if commit is not None:
            found = log.filter(F.col(COMMIT_COLUMN) == commit).select(F.col(COMMITTED_AT).cast("string")).first()
            if found is None:
                raise ValueError(f"{table} has no commit {commit}")
            timestamp = found[0]
        seen = log.filter(F.col(COMMITTED_AT) <= as_of_column(timestamp).cast("timestamp")).select(COMMIT_COLUMN)
        return self.read(table).join(seen, COMMIT_COLUMN, "left_semi")

    def read_latest(self, table: str, keys: list[str], before: str | None = None) -> DataFrame:
        """Of the rows that share ``keys`` the one of the last commit (of one
        writer: its commits sort in batch order); ``before``: of the commits
        before that one. For tables whose writer writes a row again to
        replace it: one grouped maximum, no window over a key's history."""
        rows = self.read(table)
        if before is not None:
            rows = rows.filter(F.col(COMMIT_COLUMN) < before)
        rest = F.struct(*[c for c in rows.columns if c not in keys])
        return rows.groupBy(*keys).agg(F.max_by(rest, COMMIT_COLUMN).alias("_last")).select(*keys, "_last.*")

    def snapshots(self, table: str) -> DataFrame:
        """O-61: one row per commit (id, commit time, rows), empty commits
        included, from the commit log alone."""
        if self.provider == "iceberg":
            return self.spark.sql(f"SELECT * FROM {self.qualified(table)}.snapshots")
        schema = T.StructType([T.StructField(COMMITTED_AT, T.TimestampType()), T.StructField("rows", T.LongType()),
                               T.StructField(COMMIT_COLUMN, T.StringType())])
        fs, path = self._file_system(self._commits_path(table))
        log = (self.spark.read.schema(schema).parquet(self._commits_path(table)) if fs.exists(path)
               else self.spark.createDataFrame([], schema))
        return log.select(COMMIT_COLUMN, COMMITTED_AT, "rows")

    def _commits_path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/_commits/{table}"

    # -- maintenance: the table format's own procedures --------------------
    def expire_snapshots(self, table: str, older_than=None, keep_last: int = 1) -> None:
        """O-62: forget snapshots older than ``older_than`` (default: 7 days
        before now), keeping the newest ``keep_last``; live rows stay."""
        self._needs_iceberg("expiring snapshots")
        cutoff = f"TIMESTAMP '{older_than}'" if older_than is not None else "current_timestamp() - INTERVAL 7 DAYS"
        self.spark.sql(f"CALL {self.catalog}.system.expire_snapshots(table => '{self.qualified(table)}', "
                       f"older_than => {cutoff}, retain_last => {int(keep_last)})")

    def compact(self, table: str, target_bytes: int = S.COMPACTION_TARGET_BYTES) -> None:
        """O-63: bin-pack data files to about ``target_bytes`` each."""
        self._needs_iceberg("compaction")
        self.spark.sql(f"CALL {self.catalog}.system.rewrite_data_files(table => '{self.qualified(table)}', "
                       f"strategy => 'binpack', options => map('target-file-size-bytes', '{int(target_bytes)}'))")

    def _needs_iceberg(self, what: str) -> None:
        if self.provider != "iceberg":
            raise NotImplementedError(f"{what} needs the iceberg provider: plain Parquet folders are append-only")

    def add_column(self, table: str, name: str, data_type: str) -> None:
        """O-64: add an optional column. Parquet: the column is recorded
        beside the table, later writes store it and old rows read NULL;
        Iceberg alters the table metadata."""
        if self.provider == "iceberg":
            self.spark.sql(f"ALTER TABLE {self.qualified(table)} ADD COLUMN {name} {data_type}")
            return
        if name not in self.schema(table).fieldNames():
            row = self.spark.range(1).select(F.lit(name).alias("name"), F.lit(data_type).alias("type"))
            row.coalesce(1).write.mode("append").parquet(self._columns_path(table))

    def _columns_path(self, table: str) -> str:
        # a hidden folder to readers of the root, and no part of any table
        return f"{self.root.rstrip('/')}/_columns/{table}"

    def schema(self, table: str) -> T.StructType:
        """The table's declared columns and those added since."""
        declared, _ = S.TABLES[table]
        if self.provider == "iceberg":
            return declared
        fs, path = self._file_system(self._columns_path(table))
        added = self.spark.read.schema("name string, type string").parquet(self._columns_path(table)).collect() if fs.exists(path) else []
        extra = {r["name"]: r["type"] for r in added}  # one row per added column
        return T.StructType(declared.fields + [T.StructField(n, T.DataType.fromDDL(extra[n])) for n in sorted(extra)])
