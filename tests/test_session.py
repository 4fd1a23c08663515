import time

from pyspark.sql import functions as F

from tidemark.session import shared_path, shuffles_removed, stored

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Session:
    """Stands in for a session of which only settings are asked."""

    def __init__(self, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_the_named_folder_is_used():
    session = Session(spark_checkpoint_dir="/shared/x/", spark_master="spark://host:7077")
    assert shared_path(session, "t").startswith("/shared/x/t-")
    assert shared_path(session, "t") != shared_path(session, "t")


def test_the_warehouse_stands_in_for_an_unset_folder():
    session = Session(spark_sql_warehouse_dir="hdfs://store/wh/")
    assert shared_path(session, "t").startswith("hdfs://store/wh/_scratch/t-")


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    out = stored(spark.range(2000).groupBy(F.expr("id % 100 AS k")).agg(F.max("id").alias("id")), "shuffled")
    for _ in range(25):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before
    assert out.count() == 100


def test_the_setting_of_the_session_comes_back(spark):
    was = spark.conf.get(CLEANUP, "false")
    with shuffles_removed(spark):
        with shuffles_removed(spark):
            assert spark.conf.get(CLEANUP) == "true"
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP) == was
