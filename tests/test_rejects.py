"""Rejects counted by the pass that does the work, and limits that fail it."""

import os

import plans
import pytest
from conftest import rows

from sparktally import schemas
from sparktally.operators.rejects import Rejects, TooManyRejects, checked_batches, write_checked
from sparktally.sources import readers
from sparktally.streaming import pipeline as p

LINES = ["1,10,4.5,100", "2,11,oops,100", "3,12", "", "4,13,,100", "5,14,3,100", "6,15,2.5,x"]


@pytest.fixture
def ratings(tmp_path):
    path = tmp_path / "ratings.txt"
    path.write_text("\n".join(LINES))
    return str(path)


def test_counts_come_from_the_same_scan(spark, ratings, tmp_path):
    rejects = Rejects()
    read = readers.read_ratings(spark, ratings, rejects=rejects)
    got = read.collect()
    assert [r.user_id for r in got] == ["1", "5", "6"]
    assert rejects.counts == {"n_rows": 6, "n_short": 1, "n_bad_rating": 2}
    assert plans.executed(read)["FileSourceScanExec"] == 1
    again = readers.rating_rejects(spark, ratings).first()
    assert again.asDict() == rejects.counts


@pytest.mark.parametrize("limit,fails", [({"most_rows": 2}, True), ({"most_rows": 3}, False), ({"most_share": 0.49}, True),
                                         ({"most_share": 0.5}, False), ({}, False)])
def test_a_limit_fails_the_job(spark, ratings, tmp_path, limit, fails):
    rejects, out = Rejects(**limit), str(tmp_path / "out")
    read = readers.read_ratings(spark, ratings, rejects=rejects)
    if fails:
        with pytest.raises(TooManyRejects, match="3 of 6 rows"):
            write_checked(read, out, rejects)
        assert not os.path.exists(out)
    else:
        write_checked(read, out, rejects)
        assert spark.read.parquet(out).count() == 3


def test_no_rows(spark, tmp_path):
    (tmp_path / "none.txt").write_text("")
    rejects = Rejects(most_share=0.0)
    write_checked(readers.read_ratings(spark, str(tmp_path / "none.txt"), rejects=rejects), str(tmp_path / "out"), rejects)
    assert sum(rejects.counts.values()) == 0


def test_batches_are_sorted_out_in_one_pass(spark, tmp_path):
    good = '{"frame_id": "a", "person_count": 2}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(f"{good}\nno json\n{good}\n")
    counted = {}

    def run(**limits):
        write = checked_batches(str(tmp_path / "out"), p.sorted_messages(schemas.DETECTION_RECORD), report=counted.__setitem__,
                                **limits)
        p.store_batches(spark.readStream.text(str(tmp_path / "in")), write, str(tmp_path / "check"),
                        available_now=True).awaitTermination()

    with pytest.raises(Exception, match="1 of 3 rows"):
        run(most_rows=0)
    assert not (tmp_path / "out" / "batch_id=0").exists() and not counted
    run(most_rows=1)  # the same batch again
    assert counted == {0: {"n_rows": 3, "n_malformed": 1}}
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert rows(stored.select("kind", "value", "frame_id", "person_count")) == [
        ("malformed", "no json", None, None), ("record", None, "a", 2), ("record", None, "a", 2)]
