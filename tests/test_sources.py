import os

from pyspark.sql import functions as F

from locations import SF_SMALL
from vecforge.operators import rowid
from vecforge.plans.common import vectors
from vecforge.sources import csv


def test_label_first_round_trip(spark, tmp_dir):
    src = vectors(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "lf")
    d = csv.write_label_first(src, path)
    assert d == 64
    wide = csv.read_label_first(spark, path, n_features=64)
    assert len(wide.columns) == 65 and dict(wide.dtypes)["_c0"] == "int"
    back = csv.split_label_features(wide)
    a = sorted((r["label"], tuple(round(v, 9) for v in r["vec"])) for r in back.collect())
    b = sorted((r["label"], tuple(round(v, 9) for v in r["vec"])) for r in src.collect())
    assert a == b


def test_inferred_schema_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lf")
    csv.write_label_first(vectors(spark, SF_SMALL), path)
    wide = csv.read_label_first(spark, path, infer_schema=True)
    types = dict(wide.dtypes)
    assert types["_c0"] == "int" and types["_c1"] == "double"


def test_split_layout_pairs_rows(spark, tmp_dir):
    src = vectors(spark, SF_SMALL)
    f, l = os.path.join(tmp_dir, "f"), os.path.join(tmp_dir, "l")
    csv.write_split_layout(src, f, l, order_by="id", partitions=5)
    assert len([x for x in os.listdir(f) if x.endswith(".csv")]) > 1   # several files
    both = csv.read_split_layout(spark, f, l, 64).collect()
    ref = {r["id"]: (r["label"], round(r["vec"][0], 9)) for r in src.collect()}
    got = {r["row_index"]: (r["label"], round(r["vec"][0], 9)) for r in both}
    ids = sorted(ref)
    assert sorted(got) == list(range(len(ids)))
    assert all(got[i] == ref[ids[i]] for i in range(len(ids)))


def test_file_order_index_many_files(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ids")
    spark.range(0, 1000).repartitionByRange(7, "id").sortWithinPartitions("id").write.parquet(path)
    idx = rowid.with_file_order_index(spark.read.parquet(path)).collect()
    assert all(r["id"] == r["row_index"] for r in idx)


def test_row_id_unique(spark):
    df = rowid.with_row_id(spark.range(0, 5000).repartition(5), "rid")
    row = df.agg(F.count("*").alias("n"), F.count_distinct("rid").alias("d")).first()
    assert row["n"] == row["d"] == 5000


def test_report_round_trip(spark, tmp_dir):
    rep = spark.createDataFrame([(0, 0.5, 0.25, 0.333), (1, 1.0, 0.0, 0.0)],
                                "class int, precision double, recall double, f_score double")
    path = os.path.join(tmp_dir, "rep")
    csv.write_report(rep, path)
    assert len([x for x in os.listdir(path) if x.endswith(".csv")]) == 1
    back = csv.read_report(spark, path, rep.schema)
    assert sorted(back.collect()) == sorted(rep.collect())


def test_report_lines(spark):
    rep = spark.createDataFrame([(0, 0.5, 0.25, 0.333)], "class int, precision double, recall double, f_score double")
    assert csv.report_lines(rep) == ["class\tprecision\trecall\tf_score", "0\t0.5\t0.25\t0.333"]


def test_four_file_layout_feeds_knn(spark, tmp_dir):
    from vecforge.operators import knn
    from vecforge.sources.tables import split_train_test
    train, test = split_train_test(vectors(spark, SF_SMALL))
    paths = {n: os.path.join(tmp_dir, n) for n in ("trf", "trl", "tef", "tel")}
    csv.write_split_layout(train, paths["trf"], paths["trl"], order_by="id", partitions=3)
    csv.write_split_layout(test, paths["tef"], paths["tel"], order_by="id", partitions=2)
    tr, te = csv.read_four_file_layout(spark, paths["trf"], paths["trl"], paths["tef"], paths["tel"], 64)
    assert tr.count() == train.count() and te.count() == test.count()
    # same labels per position as the id-ordered source, and the same predictions
    got = sorted(r["prediction"] for r in knn.classify(te, tr, 5).collect())
    want = sorted(r["prediction"] for r in knn.classify(test, train, 5).collect())
    assert got == want
