"""Kept constraint counts: equal to the full report after every batch."""

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import kept_constraints, quality
from tidemark.plans import queries
from tidemark.sources import state_table

SF_DIR = "/root/testdata/sf0.001"


def _applied(tables, found):
    """The tables after a batch of changes."""
    out = dict(tables)
    for name, df in found.items():
        touched = df.select(F.coalesce("after_data.id", "before_data.id").alias("id"))
        rows = df.filter("operation <> 'd'").select("after_data.*")
        out[name] = tables[name].join(touched, "id", "left_anti").select(*rows.columns).unionByName(rows)
    return out


def _rows(df):
    return sorted(map(tuple, df.select("table_name", "rule", "column_name", "violations").collect()))


def test_equal_to_the_full_report_after_each_batch(spark, out):
    stored = queries._stored(spark, SF_DIR)
    tables = {n: stored[n].limit(0) for n in ("customers", "orders")}
    for batch, found in enumerate(queries._table_changes(spark, SF_DIR)):
        tables = _applied(tables, found)
        state_table.update(kept_constraints.signed_values(found), out, kept_constraints.added, 4, batch)
        counts = state_table.read(spark, out, schemas.struct(kept_constraints.COUNTS))
        got = _rows(kept_constraints.report(counts, ["customers", "orders"]))
        assert got == _rows(quality.constraint_report(tables))
    assert sum(r[3] for r in got) > 0 and {r[1] for r in got if r[3]} == {"not null", "unique", "foreign key"}
