"""Counting what a job leaves out in the pass that does the work, and failing it when that is too much."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from sparktally.session import discard


class TooManyRejects(RuntimeError):
    """More rows were left out than the limit allows."""


class Rejects:
    """Counts per reason, known once the watched rows have been computed, and a limit for them.

    `most_rows` and `most_share` (of all rows) bound the rows left out.  A
    row may have one reason only, so the reasons' counts add up.
    """

    def __init__(self, most_rows: int | None = None, most_share: float | None = None):
        self.most_rows, self.most_share = most_rows, most_share
        self._seen = Observation()

    def watch(self, rows: DataFrame, **reasons: Column) -> DataFrame:
        """`rows`, counted as they pass, in all and per reason.  Once per object."""
        return rows.observe(self._seen, F.count(F.lit(1)).alias("n_rows"),
                            *[F.count_if(reason).alias(name) for name, reason in reasons.items()])

    @property
    def counts(self) -> dict[str, int]:
        """n_rows and the count of each reason; waits for the action on the watched rows.

        Without any row Spark hands over no counts: they are 0.
        """
        return {name: n or 0 for name, n in self._seen.get.items()}

    def check(self) -> None:
        """Raise if the limit is passed."""
        counts = self.counts
        n_rows = counts.pop("n_rows", 0)
        left_out = sum(counts.values())
        over = self.most_rows is not None and left_out > self.most_rows
        over |= self.most_share is not None and left_out > self.most_share * n_rows
        if over:
            raise TooManyRejects(f"{left_out} of {n_rows} rows left out: {counts}")


def write_checked(rows: DataFrame, path: str, *rejects: Rejects, fmt: str = "parquet") -> None:
    """Write rows that `rejects` watch to a new folder; beyond a limit the folder is deleted and the job fails."""
    rows.write.mode("errorifexists").format(fmt).save(path)
    try:
        for each in rejects:
            each.check()
    except TooManyRejects:
        discard(rows.sparkSession, path)
        raise


def checked_batches(path: str, sort_out: Callable[[DataFrame, Rejects], DataFrame], most_rows: int | None = None,
                    most_share: float | None = None,
                    report: Callable[[int, dict[str, int]], None] | None = None) -> Callable[[DataFrame, int], None]:
    """A `store_batches` writer: kept rows and rejects of a batch from one pass, below `path`.

    `sort_out` watches the batch and returns its rows with a column `kind`; every kind has
    a folder of its own.  A batch is one folder, replaced when the batch is repeated.
    A batch beyond the limits fails the query before it is committed, with nothing left behind.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rejects = Rejects(most_rows, most_share)
        folder = f"{path}/batch_id={batch_id}"
        sort_out(batch, rejects).write.mode("overwrite").partitionBy("kind").parquet(folder)
        try:
            rejects.check()
        except TooManyRejects:
            discard(batch.sparkSession, folder)
            raise
        if report is not None:
            report(batch_id, rejects.counts)
    return write
