"""The kept state: equal to the rebuilt one, moved nowhere, rewritten only where it changes."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import state
from tidemark.sources import snapshots, state_table


def _changes(spark, rows):
    """Changes (id, time, offset, operation, email)."""
    fields = schemas.row_schema("customers").fields
    image = f"struct<{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in fields)}>"
    df = spark.createDataFrame(rows, "id bigint, source_timestamp bigint, offset bigint, operation string, email string")
    names = [F.col("id") if f.name == "id" else F.col("email") if f.name == "email" else F.lit(None) for f in fields]
    row = F.struct(*[c.alias(f.name) for c, f in zip(names, fields)]).cast(image)
    gone = F.col("operation") == "d"
    return df.select("operation", "source_timestamp", "offset", F.when(gone, row).alias("before_data"), F.when(~gone, row).alias("after_data"))


def _live(spark, path):
    return sorted((r.id, r.email) for r in state_table.live(spark, path, schemas.row_schema("customers")).collect())


def _files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).glob("bucket=*/version=*/*.parquet")}


FIRST = [(i, 1, i, "c", f"a{i}") for i in range(200)]


def test_updates_equal_the_rebuilt_table(spark, out):
    later = [(3, 2, 500, "u", "b3"), (4, 2, 501, "d", None), (900, 2, 502, "c", "n"), (5, 0, 1, "u", "too early")]
    again = [(4, 3, 600, "c", "back"), (3, 2, 499, "u", "earlier offset"), (None, 9, 9, "u", "no key"), (6, 9, 9, "t", "x")]
    seen = []
    for rows in (FIRST, later, again, []):
        seen += rows
        state_table.merge(_changes(spark, rows), out, buckets=8)
        assert _live(spark, out) == sorted((r.id, r.email) for r in state.current_state(_changes(spark, seen)).collect())
    assert (3, "b3") in _live(spark, out) and (4, "back") in _live(spark, out) and (5, "a5") in _live(spark, out)


def test_untouched_buckets_keep_their_files(spark, out):
    state_table.merge(_changes(spark, FIRST), out, buckets=8)
    before = _files(out)
    touched = state_table.merge(_changes(spark, [(7, 5, 999, "u", "new")]), out)
    assert len(touched) == 1 and len(before) == 8
    after = _files(out)
    assert {f: t for f, t in after.items() if f in before} == before
    assert [f.split("/")[:2] for f in after if f not in before] == [[f"bucket={touched[0]}", "version=2"]]
    state_table.merge(_changes(spark, [(7, 6, 1000, "u", "newer")]), out)
    assert f"bucket={touched[0]}/version=1" not in {f.rsplit("/", 1)[0] for f in _files(out)}


def test_kept_side_is_not_moved(spark, out):
    state_table.merge(_changes(spark, FIRST), out, buckets=8)
    now = snapshots.latest(spark, out)
    new = state.latest_changes(_changes(spark, [(7, 5, 999, "u", "new")]))
    kept = state_table._kept(spark, state_table._registered(spark, out, new.schema, 8), now, [1, 2])
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            plan = state_table.merged(kept, new)._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        above_scan = plan[: plan.index("FileScan parquet")].rsplit("Join", 1)[1]
        assert "Exchange" not in above_scan and "Bucketed: true" in plan and "InMemoryFileIndex(2 paths)" in plan


@pytest.mark.parametrize("step", ["publish", "names"])
def test_update_is_all_or_nothing(spark, out, monkeypatch, step):
    """Ends after the rows are written, and after the snapshot."""
    state_table.merge(_changes(spark, FIRST), out, buckets=8)
    before = _live(spark, out)
    update = _changes(spark, [(i, 5, 900 + i, "u", f"b{i}") for i in range(0, 200, 3)])

    def ends(*args):
        raise RuntimeError("ended")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError, match="ended"):
        patched.setattr(snapshots, step, ends) if step == "publish" else patched.setattr(state_table, "_tidy", ends)
        state_table.merge(update, out)
    wanted = [(i, f"b{i}" if i % 3 == 0 else f"a{i}") for i in range(200)]
    assert _live(spark, out) == (before if step == "publish" else wanted)
    state_table.merge(update, out)
    assert _live(spark, out) == wanted


def test_another_session_reads_the_table(spark, out):
    state_table.merge(_changes(spark, FIRST), out, buckets=4)
    state_table.merge(_changes(spark, [(1, 5, 999, "d", None)]), out)
    for found in spark.catalog.listTables():
        if found.name.startswith("tidemark_state"):
            spark.sql(f"DROP TABLE {found.name}")
    assert len(_live(spark, out)) == 199
    customer = schemas.row_schema("customers")
    assert state_table.latest(spark, out, customer).count() == 200
    assert state_table.live(spark, out + "/none", customer).count() == 0
