import pytest
from pyspark.sql import functions as F

from vecforge import session
from vecforge.operators.blocks import PARTITION_BYTES, plan_grid
from vecforge.operators.rowid import file_order


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder, self.given = master, None, folder

    def getCheckpointDir(self):
        return self.folder

    def getConf(self):
        return {"spark.checkpoint.dir": self.given} if self.given else {}

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, *args):
        self.sparkContext = Context(*args)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://x", "local-cluster[3,2,1000]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session(master))
    assert session.checkpoint_dir(Session(master, "hdfs:///shared")) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_local_masters_have_a_private_one(master):
    assert session.checkpoint_dir(Session(master))


def test_files_go_by_part_number(spark):
    """Past 99,999 files names are longer, and the order of strings is not that of the writer."""
    n = 100_001
    paths = spark.range(n).select(F.col("id"), F.concat(F.lit("file:/x/part-"), F.lpad(F.col("id").cast("string"), 5, "0"),
                                                        F.lit("-abc.csv")).alias("p"))
    # lpad cuts longer numbers: take those as they are
    paths = paths.withColumn("p", F.when(F.col("id") > 99999, F.concat(F.lit("file:/x/part-"), F.col("id").cast("string"),
                                                                       F.lit("-abc.csv"))).otherwise(F.col("p")))
    got = [r.id for r in paths.orderBy(*file_order(F.col("p"))).select("id").collect()]
    assert got == list(range(n))


def test_grid_partitions_follow_bytes():
    """Task input is bounded whatever the parallelism is when the plan is made."""
    grid = plan_grid(10_000_000, 100_000_000, 64, 2)
    parts = grid.partitions(2)
    assert parts == grid.cells or grid.shuffle_bytes / parts <= PARTITION_BYTES
    assert grid.shuffle_bytes < 20e12  # at 8,192 rows a block it was 130 TB
