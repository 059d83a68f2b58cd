"""A table kept as a log of folded batches.

Plain Parquet has no row updates. Each batch is folded to one row per key and
written to its own folder, named by the run that writes and the batch's number
in it: writing a batch twice gives the same folder, two runs never share one,
and the cost of a batch depends on the batch, not on the table. Reading folds
the batches once more, because the fold is associative; ``compact`` stores that
result, and beside it which batches it covers, as ranges of numbers by run, so
that readers start from it. Lists on the driver are as long as there are batches
since the last compaction, and runs; ``compact_every`` bounds the former.

Runs are ordered by when they first wrote (those that start together by name),
batches by number within their run.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacancylake.functions import dates
from vacancylake.operators.upsert import LISTING_KEY, SEEN

REJECT_DDL = "page_id bigint, platform string, row_no int, problem string"


class PostingLog:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        columns: dict[str, str],
        key: list[str] | None = None,
        seen: str = SEEN,
        last_wins: list[str] | None = None,
    ):
        self.spark, self.path = spark, path
        self.key = key or LISTING_KEY
        self.last = [seen, *(last_wins or [])]
        self.columns = list(columns)
        self.first = [c for c in columns if c not in self.key and c not in self.last]
        fields = {**columns, "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"}
        self._schema = ", ".join(
            [f"{k} {fields[k]}" for k in self.key]
            + [f"{name} struct<{', '.join(f'{c}: {fields[c]}' for c in part)}>" for name, part in (
                ("first", [*self.first, "created_at"]), ("last", [*self.last, "updated_at"]))]
            + ["writes bigint"]
        )

    def append(self, writes: DataFrame, batch_id: int, as_of: str | dt.datetime, order: list[str], run: str = "direct") -> None:
        """Store one batch of writes of ``run``. Repeating a batch id of the same run replaces that batch."""
        now = dates.moment(as_of)
        at = F.struct(*order)
        folded = writes.groupBy(*self.key).agg(
            F.min_by(F.struct(*self.first, now.alias("created_at")), at).alias("first"),
            F.max_by(F.struct(*self.last, now.alias("updated_at")), at).alias("last"),
            F.count("*").alias("writes"),
        )
        folded.write.mode("overwrite").parquet(f"{self.path}/batches/run={self._run(run)}/batch={batch_id}")

    def append_rejects(self, rejects: DataFrame, batch_id: int, run: str = "direct") -> None:
        """Store what the batch left out, in a folder of its own under the batch's run and number."""
        rejects.write.mode("overwrite").parquet(f"{self.path}/rejects/run={self._run(run)}/batch={batch_id}")

    def rejects(self) -> DataFrame:
        """Everything left out so far, with run and batch."""
        reader = self.spark.read.schema(f"{REJECT_DDL}, run string, batch bigint").option("basePath", f"{self.path}/rejects")
        folders = [path.rsplit("/", 1)[0] for path in self._found("rejects/run=*/batch=*/_SUCCESS")]
        return reader.parquet(*folders) if folders else self.spark.createDataFrame([], f"{REJECT_DDL}, run string, batch bigint")

    def batch_counts(self) -> DataFrame:
        """Writes of every batch that is not removed: run, batch, writes; those before folding."""
        reader = self.spark.read.schema(f"{self._schema}, run string, batch bigint").option("basePath", f"{self.path}/batches")
        folders = [path.rsplit("/", 1)[0] for path in self._found("batches/run=*/batch=*/_SUCCESS")]
        empty = self.spark.createDataFrame([], "run string, batch bigint, writes bigint")
        return reader.parquet(*folders).groupBy("run", "batch").agg(F.sum("writes").alias("writes")) if folders else empty

    def _run(self, name: str) -> str:
        """The run's folder: a rank among runs in front of its name, given when it first writes.

        New runs that start together may take the same rank; the name behind it then orders them.
        """
        known = [path.split("=")[-1] for path in self._found("batches/run=*")]
        own = [r for r in known if r.split("-", 1)[1] == name]
        return own[0] if own else f"{max((int(r.split('-', 1)[0]) for r in known), default=0) + 1:08d}-{name}"

    def current(self) -> DataFrame:
        """The table: first-write columns, last-write columns, both stamps."""
        base, _, batches = self._parts()
        folded = self._folded(base, batches)
        return folded.select(*self.key, "first.*", "last.*").select(*self.columns, "created_at", "updated_at")

    def compact(self) -> None:
        """Store the fold of all batches so far; older parts stay until removed by their owner."""
        base, covered, batches = self._parts()
        if not batches:
            return
        number = 0 if base is None else base + 1
        for run, batch in batches:
            covered.setdefault(run, []).append((batch, batch))
        rows = [(run, low, high) for run, spans in sorted(covered.items()) for low, high in _joined(spans)]
        covers = self.spark.createDataFrame(rows, "run string, low long, high long")
        covers.write.mode("overwrite").parquet(f"{self.path}/covers/base={number}")  # a base counts once its own files are complete
        self._folded(base, batches).write.mode("overwrite").parquet(f"{self.path}/bases/base={number}")

    def compact_beyond(self, batches: int) -> None:
        """``compact`` where more than so many batches wait for it."""
        if len(self._parts()[2]) > batches:
            self.compact()

    def _folded(self, base: int | None, batches: list[tuple[str, int]]) -> DataFrame:
        parts = []
        if base is not None:
            stored = self.spark.read.schema(self._schema).parquet(f"{self.path}/bases/base={base}")
            parts.append(stored.withColumns({"run": F.lit(""), "batch": F.lit(0).cast("long")}))  # before every run
        if batches:
            reader = self.spark.read.schema(f"{self._schema}, run string, batch bigint").option("basePath", f"{self.path}/batches")
            parts.append(reader.parquet(*[f"{self.path}/batches/run={r}/batch={b}" for r, b in batches]))
        if not parts:
            return self.spark.createDataFrame([], self._schema)
        number = F.struct("run", "batch")
        return reduce(DataFrame.unionByName, parts).groupBy(*self.key).agg(
            F.min_by("first", number).alias("first"),
            F.max_by("last", number).alias("last"),
            F.sum("writes").alias("writes"),
        )

    def _parts(self) -> tuple[int | None, dict[str, list[tuple[int, int]]], list[tuple[str, int]]]:
        """The newest complete base, the ranges of batches it covers by run, and the other complete batches."""
        bases = [int(path.split("/")[-2].split("=")[1]) for path in self._found("bases/base=*/_SUCCESS")]
        base = max(bases, default=None)
        covered: dict[str, list[tuple[int, int]]] = {}
        if base is not None:
            for r in self.spark.read.parquet(f"{self.path}/covers/base={base}").collect():  # a row per run, more where numbers have gaps
                covered.setdefault(r["run"], []).append((r["low"], r["high"]))
        folders = [path.split("/")[-3:-1] for path in self._found("batches/run=*/batch=*/_SUCCESS")]
        found = sorted((run.split("=")[1], int(batch.split("=")[1])) for run, batch in folders)
        return base, covered, [(r, b) for r, b in found if not any(low <= b <= high for low, high in covered.get(r, ()))]

    def _found(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return [str(f.getPath().toString()) for f in files or []]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of numbers, those that touch made one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out
