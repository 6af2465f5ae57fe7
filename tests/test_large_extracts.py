"""Derived tariffs are made by as many tasks as their customers need, whatever the file's layout."""

from pyspark.sql import functions as F

from tests.helpers import values
from verification import inputs, stream_runs


def customers_in_one_file(spark, folder, n):
    spark.range(n).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{folder}/customer.parquet")
    return folder


def test_no_task_makes_the_tariffs_of_all_customers(spark, folder):
    n = 4 * inputs.CUSTOMERS
    extract = inputs.tariff_extract(spark, customers_in_one_file(spark, folder, n))
    tasks = [r["count"] for r in extract.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    everyone = [c for c in range(n) if c % 29 != 5]
    assert sum(tasks) == inputs.DAYS * sum(1 + (c % 17 == 3) + (c % 19 == 4) for c in everyone)
    assert max(tasks) < 1.2 * inputs.CUSTOMERS * inputs.DAYS * 1.12


def test_a_day_of_tariffs_is_few_files(spark, folder):
    sf_dir = customers_in_one_file(spark, folder, 4 * inputs.CUSTOMERS)
    path = stream_runs.tariff_folder(spark, sf_dir)
    rows = spark.read.option("header", True).csv(path)
    files = rows.groupBy("day").agg(F.count_distinct("_metadata.file_path").alias("n"))
    assert {n for (n,) in values(files, "n")} <= {1, 2}
    assert files.count() == stream_runs.LAST_DAY


def test_the_extract_of_a_day_makes_no_other_day(spark, folder):
    sf_dir = customers_in_one_file(spark, folder, 300)
    day = inputs.tariff_extract(spark, sf_dir, 4, 4)
    whole = inputs.tariff_extract(spark, sf_dir).where("sim_day = '4'")
    assert day.count() == whole.count() > 0
    assert day.exceptAll(whole).isEmpty()
