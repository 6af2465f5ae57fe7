"""Stored inputs leave no shuffle files behind, which would add up over the inputs of a query."""

from pyspark.sql import functions as F

from verification import inputs


def test_a_stored_table_leaves_no_shuffle_files(spark):
    def blocks():
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = disk.getAllFiles()
        names = {files.apply(i).getName() for i in range(files.size())}
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    def by_remainder(spark, sf_dir):
        return spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 7).alias("r")).count()

    before = blocks()
    assert inputs.stored(by_remainder)(spark, "leftovers").count() == 7
    # The count of the stored rows has a shuffle of its own, of one number.
    assert len(blocks() - before) <= 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"
