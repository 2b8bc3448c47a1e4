"""Published runs: every stable name switches in one statement, and a run in use is not dropped.

A run is a set of tables ``<name>_<run id>``. The one pointer is the view ``<silver>._published``, which holds a run id.
Stable names, silver and gold, are views with a branch for the run about to be published and one for the run in force; each
branch is guarded by the pointer:

    SELECT ... FROM books_<new> WHERE (SELECT run_id FROM _published) = '<new>'
    UNION ALL SELECT ... FROM books_<old> WHERE (SELECT run_id FROM _published) = '<old>'

The pointer is a constant, so the optimiser folds the guards and one branch is left in any plan. While the views are replaced one by one the pointer
still names the old run and every view returns it; replacing the pointer is the publication. A publication that dies before
that leaves the old run in force, and the next one starts from it.

A ``Snapshot`` pins one run for longer than one query: it takes a lease, a small file with a time of expiry, and reads that run's tables
whatever is published meanwhile. Publishing drops the tables of runs that are neither in force, nor the one before, nor leased; a build takes a lease
on its own run while it writes. Publications of one namespace exclude each other by a lock file, which expires too.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from folio.functions import DEFAULT_M
from folio.plans.views_sql import MARK, gold_views
from folio.sources import storage

RUN_TABLES = ["ratings_all", "rating_stats", "quarantine_books", "books", "book_enrichment", "users", "priors"]
STABLE_NAMES = ["ratings", "quarantine_ratings", "books", "quarantine_books", "book_enrichment", "users", "rating_stats", "priors"]
LEASE_SECONDS = 6 * 3600
# Both rating outputs are partitions of one table.
_RATINGS = {
    "ratings": ("user_id, isbn, rating, _source_file, _ingested_at, is_explicit, _transformed_at", "NOT _quarantined"),
    "quarantine_ratings": ("user_id, isbn, rating, _source_file, _ingested_at, reason", "_quarantined"),
}


class Snapshot:
    """One run, whatever is published meanwhile."""

    def __init__(self, spark: SparkSession, silver_db: str, run_id: str):
        self.spark, self.silver_db, self.run_id = spark, silver_db, run_id

    def table(self, name: str) -> DataFrame:
        if name in _RATINGS:
            columns, which = _RATINGS[name]
            return self.spark.table(f"{self.silver_db}.ratings_all_{self.run_id}").where(which).select(*columns.split(", "))
        return self.spark.table(f"{self.silver_db}.{name}_{self.run_id}")

    def view(self, name: str, m: int = DEFAULT_M) -> DataFrame:
        """A gold view of this run."""
        return self.spark.sql(gold_views(lambda t: f"{self.silver_db}.{t}_{self.run_id}", m)[name].body)


class Snapshots:
    """The runs of one silver namespace."""

    def __init__(self, spark: SparkSession, silver_db: str):
        self.spark, self.db = spark, silver_db
        self._place: str | None = None

    @property
    def place(self) -> str:
        """Folder for leases and the lock, inside the namespace's own location."""
        if self._place is None:
            rows = self.spark.sql(f"DESCRIBE DATABASE {self.db}").where("info_name = 'Location'").collect()
            self._place = f"{rows[-1].info_value.rstrip('/')}/_folio_runs"
        return self._place

    # ------------------------------------------------------------ pointer
    def published(self) -> str | None:
        """The run in force; None before the first publication."""
        if not self.spark.catalog.tableExists(f"{self.db}._published"):
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.db}._published ('folio.run_id')").collect()  # a catalogue lookup, no job
        return (rows[0].value or None) if rows else None

    def _point(self, run_id: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.db}._published TBLPROPERTIES ('folio.run_id' = '{run_id}') AS SELECT '{run_id}' AS run_id")

    # ------------------------------------------------------------ leases
    @contextmanager
    def lease(self, run_id: str, seconds: float = LEASE_SECONDS) -> Iterator[None]:
        path = f"{self.place}/leases/{run_id}.{uuid.uuid4().hex}"
        storage.put_if_absent(self.spark, path, str(time.time() + seconds))
        try:
            yield
        finally:
            storage.remove(self.spark, path)

    def leased(self) -> set[str]:
        """Runs with a lease that has not expired; expired ones are removed."""
        held = set()
        for name in storage.file_names(self.spark, f"{self.place}/leases"):
            if name.startswith("."):
                continue
            until = storage.read_text(self.spark, f"{self.place}/leases/{name}")
            if until and float(until) > time.time():
                held.add(name.split(".")[0])
            elif until:
                storage.remove(self.spark, f"{self.place}/leases/{name}")
        return held

    @contextmanager
    def open(self, seconds: float = LEASE_SECONDS) -> Iterator[Snapshot]:
        """Pin the run in force. If it was superseded and dropped before the lease stood, the next one is taken."""
        while True:
            run_id = self.published()
            if run_id is None:
                raise LookupError(f"{self.db} has no published run")
            with self.lease(run_id, seconds):
                if all(self.spark.catalog.tableExists(f"{self.db}.{t}_{run_id}") for t in RUN_TABLES):
                    yield Snapshot(self.spark, self.db, run_id)
                    return

    @contextmanager
    def _alone(self, seconds: float = 3600, patience: float = 600) -> Iterator[None]:
        path, until = f"{self.place}/publishing", time.time() + patience
        while not storage.put_if_absent(self.spark, path, str(time.time() + seconds)):
            held = storage.read_text(self.spark, path)
            if held and float(held) < time.time():
                storage.remove(self.spark, path)  # its holder died
            elif time.time() > until:
                raise TimeoutError(f"another publication of {self.db} is under way")
            else:
                time.sleep(0.2)
        try:
            yield
        finally:
            storage.remove(self.spark, path)

    # ------------------------------------------------------------ publication
    def _branch(self, body: str, run_id: str) -> str:
        return f"SELECT * FROM ({body}) WHERE (SELECT run_id FROM {self.db}._published) = '{run_id}'"

    def _silver_body(self, name: str, run_id: str, columns: list[tuple[str, str]]) -> str:
        """One run's rows under the given columns: NULL where this run's table lacks one."""
        source, rest = f"{self.db}.{name}_{run_id}", ""
        if name in _RATINGS:
            source, rest = f"{self.db}.ratings_all_{run_id}", f" WHERE {_RATINGS[name][1]}"
        held = {f.name for f in self.spark.table(source).schema.fields}
        chosen = [f"CAST({f'`{c}`' if c in held else 'NULL'} AS {kind}) AS `{c}`" for c, kind in columns]
        return f"SELECT {', '.join(chosen)} FROM {source}{rest}"

    def register_silver(self, runs: list[str]) -> None:
        """Stable silver names over the given runs, the newest first; its columns count."""
        newest = Snapshot(self.spark, self.db, runs[0])
        for name in STABLE_NAMES:
            columns = [(f.name, f.dataType.simpleString()) for f in newest.table(name).schema.fields]
            body = " UNION ALL ".join(self._branch(self._silver_body(name, r, columns), r) for r in runs)
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.db}.{name} AS {body}")

    def register_gold(self, gold_db: str, m: int = DEFAULT_M, runs: list[str] | None = None) -> list[str]:
        """Stable gold names over the given runs (default: the one in force), with comments.

        The namespace is remembered, and follows each later publication. Views there that this library made under other names
        are superseded and dropped.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {gold_db}")
        known = f"{self.place}/gold/{gold_db}"
        if storage.read_text(self.spark, known) != str(m):
            storage.remove(self.spark, known)
            storage.put_if_absent(self.spark, known, str(m))
        runs = runs or [r for r in [self.published()] if r]
        per_run = [gold_views(lambda t, r=r: f"{self.db}.{t}_{r}", m) for r in runs]
        for name, view in per_run[0].items():
            body = " UNION ALL ".join(self._branch(views[name].body, r) for views, r in zip(per_run, runs, strict=True))
            self.spark.sql(view.ddl(gold_db, body))
        for old in [t.name for t in self.spark.catalog.listTables(gold_db) if t.tableType == "VIEW" and not t.isTemporary and t.name not in per_run[0]]:
            if any(r.key == MARK for r in self.spark.sql(f"SHOW TBLPROPERTIES {gold_db}.{old}").collect()):
                self.spark.sql(f"DROP VIEW IF EXISTS {gold_db}.{old}")
        return [f"{gold_db}.{name}" for name in per_run[0]]

    def gold_namespaces(self) -> dict[str, int]:
        """Remembered gold namespaces that still exist, with their m."""
        names = [n for n in storage.file_names(self.spark, f"{self.place}/gold") if not n.startswith(".")]
        return {n: int(storage.read_text(self.spark, f"{self.place}/gold/{n}")) for n in names if self.spark.catalog.databaseExists(n)}

    def publish(self, run_id: str, gold_db: str | None = None, m: int = DEFAULT_M) -> None:
        """Put a complete run in force, then drop the runs that nobody can be reading."""
        with self._alone():
            previous = self.published()
            if not self.spark.catalog.tableExists(f"{self.db}._published"):
                self._point("")
            runs = [run_id] + ([previous] if previous and previous != run_id else [])
            self.register_silver(runs)
            for name, shrink in (self.gold_namespaces() | ({gold_db: m} if gold_db else {})).items():
                self.register_gold(name, shrink, runs)
            self._point(run_id)  # the one step that readers see
            self._drop_unused({run_id, previous} | self.leased(), len(run_id))

    def _drop_unused(self, keep: set[str | None], size: int) -> None:
        for table in [t.name for t in self.spark.catalog.listTables(self.db) if t.tableType != "VIEW"]:
            name, _, run = table.rpartition("_")
            if name in RUN_TABLES and len(run) == size and run.isalnum() and run not in keep:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.db}.{table}")
