from locations import SF_SMALL
from vecforge.operators.rowid import id_counts
from vecforge.plans.vector_queries import row_id_unique


def test_duplicates_that_a_gap_offsets_are_seen(spark):
    far = 5 << 33
    for ids, distinct in (([0, 0, 2], 2), ([0, 1, 2], 3), ([far, far + 3, far + 3, 1, 1, 40_000], 4), ([], None)):
        row = id_counts(spark.createDataFrame([(i,) for i in ids], "id long").repartition(3)).first()
        assert row.n_distinct_ids == distinct and row.n_rows == (len(ids) or None)


def test_row_ids_are_unique(spark):
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert tuple(row_id_unique(spark, SF_SMALL).first()) == (n, n)
