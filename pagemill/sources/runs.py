"""A log-structured table: rows arrive in runs, each bucketed and sorted by a key.

Every ``append`` writes one new run and leaves the others as they are, so what a
round writes follows what the round brings, not what is stored. All runs share one
bucketing: a join or an aggregate on the key reads the table in its buckets, without a
shuffle, and only the other side moves (laid out by ``placed``).

Runs are folded by size: the newest ones become one run as soon as ``fanout`` or more of
them are, each, no larger than all newer ones together. A row so comes into a run twice
as large with each fold, is rewritten at most log2(rows) + 1 times, and at most
log2(rows) + ``fanout`` runs are live. Which runs are live stands in numbered manifests; a manifest is published at one
stroke and never changed, so a reader sees the table before or after a fold, and a
run whose writer died is not in any manifest and is overwritten by the next attempt.
Files of folded runs stay until the next fold for readers that still use them.

Run ids are increasing integers (rounds, batches). A run that is live or folded
away is not appended again, so replays change nothing. One writer at a time: of two,
one fails at the manifest.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.sources.files import delete, names, path_exists, publish_text, read_text, size


@dataclass(frozen=True)
class Run:
    first: int      # ids of the appended runs that it holds
    last: int
    rows: int
    bytes: int      # as written

    @property
    def name(self) -> str:
        return f"r{self.first}-{self.last}"


class BucketedRuns:
    """Runs of rows (``schema``, DDL) bucketed by ``key`` under ``root``.

    ``buckets`` is fixed when the table is made: about the stored bytes divided by 128 MB
    to 1 GB. ``options`` go to the Parquet writer. ``fold_rows`` says what a fold keeps.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str, buckets: int = 64, fanout: int = 4,
                 options: dict | None = None):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.buckets, self.fanout, self.options = int(buckets), int(fanout), dict(options or {})
        self.columns = spark.createDataFrame([], schema).columns

    # --- manifests -----------------------------------------------------------
    def _manifest(self) -> tuple[int, dict]:
        found = names(self.spark, f"{self.root}/manifests")
        if not found:
            return 0, {"live": [], "retired": []}
        return int(found[-1].split(".")[0]), json.loads(read_text(self.spark, f"{self.root}/manifests/{found[-1]}"))

    def _publish(self, number: int, live: list[Run], retired: list[str]) -> None:
        text = json.dumps({"live": [asdict(r) for r in live], "retired": retired, "buckets": self.buckets})
        if not publish_text(self.spark, f"{self.root}/manifests/{number:09d}.json", text):
            raise RuntimeError(f"another writer changed {self.root}")

    def runs(self) -> list[Run]:
        """The live runs, oldest first."""
        return [Run(**r) for r in self._manifest()[1]["live"]]

    def has(self, run_id: int) -> bool:
        return any(r.first <= run_id <= r.last for r in self.runs())

    def next_id(self) -> int:
        return max((r.last for r in self.runs()), default=-1) + 1

    # --- the table -----------------------------------------------------------
    def _table(self) -> str:
        """The catalog's table over the folder, made where this session does not have it."""
        name = f"pagemill_runs_{hashlib.sha256(self.root.encode()).hexdigest()[:20]}"
        if not self.spark.catalog.tableExists(name):
            options = ", ".join(f"'{k}' = '{v}'" for k, v in self.options.items())
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({self.schema}, run STRING) USING parquet "
                + (f"OPTIONS ({options}) " if options else "")
                + f"PARTITIONED BY (run) CLUSTERED BY ({self.key}) SORTED BY ({self.key}) "
                  f"INTO {self.buckets} BUCKETS LOCATION '{self.root}/data'")
            if path_exists(self.spark, f"{self.root}/data"):
                self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def read(self, runs: list[Run] | None = None) -> DataFrame:
        """Rows of the given runs, by default of all live ones; few, so the list of names stays short."""
        runs = self.runs() if runs is None else runs
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.table(self._table()).where(F.col("run").isin([r.name for r in runs])).select(*self.columns)

    def placed(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """``df`` dealt as the buckets are, so that a join with them moves it alone. Left to itself the
        planner may choose to move the stored side, where ``df`` has more partitions."""
        return df.repartition(self.buckets, key or self.key)

    def _drop(self, run: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._table()} DROP IF EXISTS PARTITION (run = '{run}')")
        delete(self.spark, f"{self.root}/data/run={run}")

    def _write(self, rows: DataFrame, first: int, last: int) -> Run:
        table, run = self._table(), f"r{first}-{last}"
        self._drop(run)  # what a writer that died left under this name
        view = f"pagemill_new_{uuid.uuid4().hex}"
        rows.select(*self.columns).createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT INTO {table} PARTITION (run = '{run}') SELECT * FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
        path = f"{self.root}/data/run={run}"
        n = self.spark.table(table).where(F.col("run") == run).count()  # from the files' footers
        return Run(first, last, n, size(self.spark, path))

    def append(self, rows: DataFrame, run_id: int) -> Run | None:
        """One more run; None, and nothing written, where this id was appended before."""
        number, state = self._manifest()
        live = [Run(**r) for r in state["live"]]
        if any(r.first <= run_id <= r.last for r in live):
            return None
        if live and run_id <= live[-1].last:
            raise ValueError(f"run ids increase: {run_id} comes after {live[-1].last}")
        run = self._write(self.placed(rows), run_id, run_id)
        self._publish(number + 1, [*live, run], state["retired"])
        return run

    # --- folding ---------------------------------------------------------------
    def fold_rows(self, rows: DataFrame) -> DataFrame:
        """What of the rows of adjacent runs stays; narrow over the buckets, without a shuffle."""
        return rows.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("_n")).drop("_n")

    def _foldable(self, live: list[Run]) -> int | None:
        """Where the newest runs begin that are to be folded, if any are."""
        newer, start = 0, None
        for at in range(len(live) - 1, -1, -1):
            if at < len(live) - 1 and max(live[at].rows, 1) <= newer:
                start = at
            newer += max(live[at].rows, 1)
        return start if start is not None and len(live) - start >= self.fanout else None

    def fold(self) -> list[Run]:
        """Fold the newest runs if they are due; the new run, in a list."""
        number, state = self._manifest()
        for run in state["retired"]:  # of the fold before: no reader is that old
            self._drop(run)
        live, retired, made = [Run(**r) for r in state["live"]], [], []
        if (start := self._foldable(live)) is not None:
            group = live[start:]
            run = self._write(self.fold_rows(self.read(group)), group[0].first, group[-1].last)
            live[start:] = [run]
            retired += [r.name for r in group]
            made.append(run)
        if made or state["retired"]:
            self._publish(number + 1, live, retired)
        return made
