"""The append-only bronze sink: one folder a micro-batch, written once, counted once, with columns that may be added.

A batch goes to ``<root>/_batch=<id>``; writing it again replaces that folder, so a replayed batch adds nothing. Its entry
in the ledger beside the checkpoint's own logs (``<checkpoint>/folio/batches/<id>.json``: rows, schema) is put after the data;
a batch that has one isn't written again. Last, the table learns of the batch: new columns by ALTER TABLE ADD COLUMNS,
the folder by ADD PARTITION, both without effect when repeated. Readers of the table see a batch whole or not at all.

Counts are taken while the rows are written (``Observation``) and kept in the ledger, so a run's figures cost nothing that grows with
the table's history, and stay right when a run dies between two steps.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.sources import storage

BATCH = "_batch"


class BatchSink:
    """One feed's sink: a table partitioned by batch, or a folder of the same layout."""

    def __init__(self, spark: SparkSession, checkpoint: str, name: str, table: str | None = None, path: str | None = None):
        if bool(table) == bool(path):
            raise ValueError("a sink is either a table or a path")
        self.spark, self.checkpoint, self.name, self.table, self.path = spark, checkpoint.rstrip("/"), name, table, path

    # ------------------------------------------------------------ ledger
    def _entry(self, batch: int) -> str:
        return f"{self.checkpoint}/folio/batches/{batch}.json"

    def entry(self, batch: int) -> dict | None:
        text = storage.read_text(self.spark, self._entry(batch))
        return json.loads(text) if text else None

    def last_batch(self) -> int:
        """The last committed batch of the stream, -1 if there is none."""
        return max((int(n) for n in storage.file_names(self.spark, f"{self.checkpoint}/commits") if n.isdigit()), default=-1)

    def rows(self, after: int, upto: int) -> int:
        """Rows of the batches after one and up to another, from their entries."""
        return sum((self.entry(b) or {"rows": 0})["rows"] for b in range(after + 1, upto + 1))

    # ------------------------------------------------------------ place
    def root(self) -> str | None:
        if self.path:
            return self.path.rstrip("/")
        if not self.spark.catalog.tableExists(self.table):
            return None
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table}").where("col_name = 'Location'").collect()
        return rows[-1].data_type.rstrip("/")  # the details stand after the columns, one of which may have that name

    def claim(self) -> None:
        """Refuse a sink that holds batches of another checkpoint: this one would number its own alike."""
        root = self.root()
        if root is None:
            return
        owner = f"{self.checkpoint}/folio/owner"
        storage.put_if_absent(self.spark, owner, uuid.uuid4().hex)
        own = storage.read_text(self.spark, owner)
        storage.put_if_absent(self.spark, f"{root}/_folio_owner", own)
        foreign = storage.read_text(self.spark, f"{root}/_folio_owner") != own
        if foreign or storage.file_names(self.spark, f"{root}/_spark_metadata"):
            raise RuntimeError(f"stream {self.name}: the sink was written under another checkpoint than {self.checkpoint}; "
                               "it would skip the batches it already holds. Replay into a new table.")

    def _columns(self) -> list[str]:
        return [f.name for f in self.spark.table(self.table).schema.fields]

    def _admit(self, schema: T.StructType) -> None:
        """The table with at least the columns of ``schema``."""
        if not self.spark.catalog.tableExists(self.table):
            empty = self.spark.createDataFrame([], T.StructType(schema.fields + [T.StructField(BATCH, T.LongType())]))
            empty.write.partitionBy(BATCH).format("parquet").saveAsTable(self.table)
            self.claim()
        held = {c.lower() for c in self._columns()}
        kinds = self.spark._jvm.org.apache.spark.sql.types.DataType
        more = [f"`{f.name.replace('`', '``')}` {kinds.fromJson(f.dataType.json()).sql()}" for f in schema.fields if f.name.lower() not in held]
        if more:
            self.spark.sql(f"ALTER TABLE {self.table} ADD COLUMNS ({', '.join(more)})")

    # ------------------------------------------------------------ append
    def append(self, batch: int, build: Callable[[], DataFrame], revise: Callable[[DataFrame, int], DataFrame | None] | None = None,
               flagged: str | None = None) -> int:
        """Write one batch and return its rows.

        ``flagged`` names a column whose non-null rows are counted too; where there are any, ``revise`` gets the rows just
        written and may return other rows to write in their place.
        """
        done = self.entry(batch)
        if done is None:
            df = build()
            if self.table:
                self._admit(df.schema)
            folder = f"{self.root()}/{BATCH}={batch}"
            rows, marked = self._write(df, folder, flagged)
            if marked and revise:
                again = revise(self.spark.read.schema(df.schema).parquet(folder), marked)
                if again is not None:
                    if self.table:
                        self._admit(again.schema)
                    df, (rows, marked) = again, self._write(again, folder, flagged)
            done = {"batch": batch, "rows": rows, "flagged": marked, "schema": df.schema.jsonValue()}
            storage.put_if_absent(self.spark, self._entry(batch), json.dumps(done))
        if self.table:
            self._admit(T.StructType.fromJson(done["schema"]))
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS PARTITION ({BATCH} = {batch})")
            self.spark.catalog.refreshTable(self.table)
        return done["rows"]

    def _write(self, df: DataFrame, folder: str, flagged: str | None) -> tuple[int, int]:
        seen = Observation()
        marked = F.count(F.col(flagged) if flagged else F.lit(None)).alias("marked")
        df.observe(seen, F.count(F.lit(1)).alias("rows"), marked).write.mode("overwrite").parquet(folder)
        found = seen.get
        return int(found["rows"]), int(found["marked"])

    def read(self) -> DataFrame:
        """All batches, with the columns of the newest one (NULL where an older batch lacks them)."""
        if self.table:
            return self.spark.table(self.table)
        last = self.last_batch()
        done = self.entry(last) if last >= 0 else None
        if done is None:
            return self.spark.read.option("mergeSchema", "true").parquet(self.path)
        return self.spark.read.schema(T.StructType(T.StructType.fromJson(done["schema"]).fields + [T.StructField(BATCH, T.LongType())])).parquet(self.path)
