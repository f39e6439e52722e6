"""Published tables and results that follow their facts."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import cleaning, weekly
from pulseframe.plans import incremental
from pulseframe.rules import Roles
from pulseframe.sources import published
from pulseframe.sources.paths import Folder
from pulseframe.sources.published import PublishConflict, latest_version, publish, read_published

ROLES = Roles(date="d", entity="e", product="p", category="c", region="r", quantity="q", price="x")


def weeks_of(spark, *numbers, price=1.0):
    first = date(2022, 1, 3)
    rows = [
        (first + timedelta(weeks=w, days=n % 7), f"e{n % 3}", f"p{n % 5}", None if n % 4 == 0 else "c", "r", float(n), price * n)
        for w in numbers for n in range(20 + w)
    ]
    return cleaning.with_week(spark.createDataFrame(rows, "d date, e string, p string, c string, r string, q double, x double"), "d")


class Counted:
    """Weekly features that remember which folders they were given."""

    def __init__(self):
        self.calls = []

    def __call__(self, rows):
        self.calls.append(sorted({f.split("week_start=")[1].split("/")[0] for f in rows.inputFiles()}))
        return weekly.weekly_features(rows, ROLES)


def sorted_rows(df):
    """Rows with floating point sums at the precision that does not depend on the order of the rows."""
    plain = lambda x: round(x, 9) if isinstance(x, float) else x
    return sorted((tuple(map(plain, r)) for r in df.select(sorted(df.columns)).collect()), key=repr)


def test_only_changed_weeks_are_read(spark, tmp_path):
    facts, store, compute = str(tmp_path / "facts"), str(tmp_path / "store"), Counted()
    update = lambda: incremental.refresh(spark, facts, store, "week_start", compute)
    full = lambda *rows: sorted_rows(weekly.weekly_features(rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1]), ROLES))

    incremental.batch_folders(weeks_of(spark, 0, 1, 2), facts, "week_start", "d", ["e", "q"])
    assert sorted_rows(update()) == full(weeks_of(spark, 0, 1, 2))
    assert compute.calls == [["2022-01-03", "2022-01-10", "2022-01-17"]]

    incremental.batch_folders(weeks_of(spark, 3), facts, "week_start")
    added = update()
    assert compute.calls[1:] == [["2022-01-24"]]
    assert sorted_rows(added) == full(weeks_of(spark, 0, 1, 2, 3))

    version = latest_version(spark, store)
    assert sorted_rows(update()) == sorted_rows(added)
    assert len(compute.calls) == 2 and latest_version(spark, store) == version

    incremental.batch_folders(weeks_of(spark, 1, price=9.0), facts, "week_start")
    changed = update()
    assert compute.calls[2:] == [["2022-01-10"]]
    assert sorted_rows(changed) == full(weeks_of(spark, 0, 2, 3), weeks_of(spark, 1, price=9.0))

    Folder(spark, facts).delete("week_start=2022-01-03")
    assert sorted_rows(update()) == full(weeks_of(spark, 2, 3), weeks_of(spark, 1, price=9.0))
    assert len(compute.calls) == 3


def test_rows_without_a_key_belong_to_no_batch(spark, tmp_path):
    facts = str(tmp_path / "facts")
    rows = weeks_of(spark, 0).withColumn("week_start", F.when(F.col("q") > 3, F.col("week_start")))
    incremental.batch_folders(rows, facts, "week_start")
    assert list(incremental.files_by_batch(spark, facts, "week_start")) == ["2022-01-03"]
    assert incremental.files_by_batch(spark, str(tmp_path / "nothing"), "week_start") == {}


def values(df):
    return sorted(r[0] for r in df.collect())


def test_versions_are_pinned_and_old_ones_go(spark, tmp_path):
    path = str(tmp_path / "t")
    assert read_published(spark, path) is None and latest_version(spark, path) == 0
    first = publish(spark.range(3), path)
    for n in range(4, 9):
        publish(spark.range(n), path, kept=3)
        if n == 4:
            assert values(first) == [0, 1, 2]  # still readable after a later version
    assert latest_version(spark, path) == 6
    assert values(read_published(spark, path)) == list(range(8))
    assert values(read_published(spark, path, 4)) == list(range(6))
    assert read_published(spark, path, 1) is None
    assert len(Folder(spark, f"{path}/versions").names()) == 3


def test_a_table_may_be_made_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(3), path)
    assert values(publish(read_published(spark, path).selectExpr("id + 10 AS id"), path)) == [10, 11, 12]


@pytest.mark.parametrize("step", ["write", "commit", "record"])
def test_a_killed_writer_leaves_the_old_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    publish(spark.range(3), path)

    class Killed(BaseException):
        pass

    def kill(*_, **__):
        raise Killed

    with monkeypatch.context() as patch:
        if step == "write":
            failing = spark.range(5).select(F.assert_true(F.col("id") < 3).isNull().alias("x"))
            with pytest.raises(Exception):
                publish(failing, path)
        elif step == "commit":
            patch.setattr(Folder, "create", kill)
            with pytest.raises(Killed):
                publish(spark.range(5), path)
        else:  # the record was created, its content never came
            Folder(spark, f"{path}/commits").create("000000000002", "")
    assert values(read_published(spark, path)) == [0, 1, 2]
    assert values(publish(spark.range(7), path)) == list(range(7))
    assert values(read_published(spark, path)) == list(range(7))


def test_two_writers_cannot_mix(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    publish(spark.range(1), path)
    base = latest_version(spark, path)
    publish(spark.range(2), path, after=base)
    with pytest.raises(PublishConflict):
        publish(spark.range(3), path, after=base)
    assert values(read_published(spark, path)) == [0, 1]
    assert len(Folder(spark, f"{path}/versions").names()) == 2
    # Both see the same state and try to commit; the second one to create the record loses.
    create = Folder.create

    def late(self, name, content):
        monkeypatch.setattr(Folder, "create", create)
        publish(spark.range(9), path)
        return create(self, name, content)

    monkeypatch.setattr(Folder, "create", late)
    with pytest.raises(PublishConflict):
        publish(spark.range(3), path)
    assert values(read_published(spark, path)) == list(range(9))
    assert published.KEPT_VERSIONS > 1
