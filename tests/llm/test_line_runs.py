"""Line dedup against a plain dictionary."""

import random

import pytest
import tables

from sparktally.llm import line_runs
from sparktally.session import scratch_path

_SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(_SPACE))


def by_hand(rows):
    order = lambda d: float("inf") if d is None else d
    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key_of(line), set()).add(order(doc_id))
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key_of(x)) < 10 or len(holders[key_of(x)]) < 2
                or min(holders[key_of(x)]) == order(doc_id)]
        same = len(stay) == len(lines)
        out.append((doc_id, text if same else "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=repr)


def found(df):
    return tables.table(df.select("doc_id", "text", "n_lines", "n_dropped"))


def test_awkward_rows_and_extra_columns(spark):
    docs = tables.clashing(spark)
    got = line_runs.dedup_lines(docs)
    assert set(got.columns) == set(docs.columns)
    assert found(got) == by_hand([r[:2] for r in tables.AWKWARD])
    assert {r.h1 for r in got.select("h1").collect()} == {"own h1"}


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (7, 3)])
def test_batches_do_not_change_the_result(spark, batches, fanout):
    rng = random.Random(batches)
    lines = [f"line number {i} of many" for i in range(60)] + ["short", "", "A common LINE in all of them"]
    rows = [(i * 3, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9)))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(line_runs.dedup_lines(docs, batches=batches, fanout=fanout)) == by_hand(rows)


def test_runs_are_merged_level_by_level(spark):
    runs = line_runs.LineRuns(spark, scratch_path(spark, "runs"), fanout=2)
    for i in range(5):
        keys = spark.createDataFrame([(i * 10 + j, 0) for j in range(10)], "h1 long, h2 long")
        assert runs.unseen(keys).count() == 10
        runs.add(keys)
        assert runs.unseen(keys).count() == 0
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted(r.h1 for n in runs.runs() for r in spark.table(n).collect()) == list(range(50))
    plan = runs.unseen(spark.range(100).selectExpr("id AS h1", "0L AS h2"))._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    runs.close()


def test_no_rows(spark):
    assert line_runs.dedup_lines(tables.empty(spark)).count() == 0


def test_a_failed_job_leaves_no_table(spark, monkeypatch):
    before = {t.name for t in spark.catalog.listTables()}
    calls = []

    def lost(lines, runs):
        if calls:
            raise RuntimeError("lost")
        calls.append(1)
        return dropped(lines, runs)

    dropped = line_runs.dropped_lines
    monkeypatch.setattr(line_runs, "dropped_lines", lost)
    with pytest.raises(RuntimeError):
        line_runs.dedup_lines(spark.range(50).selectExpr("id AS doc_id", "concat('line number ', id % 20) AS text"))
    assert {t.name for t in spark.catalog.listTables()} == before
