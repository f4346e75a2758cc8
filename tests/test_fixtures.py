import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from postalspark import fixtures as fx


def test_views_of_one_row_group_are_made_by_many_tasks(spark, sf_small, tmp_path):
    n = 90_000
    nation = spark.read.parquet(f"{sf_small}/nation.parquet").toPandas()
    pq.write_table(pa.Table.from_pandas(nation), f"{tmp_path}/nation.parquet")
    key = pa.array(range(n), pa.int64())
    pq.write_table(pa.table({"c_custkey": key, "c_name": pa.array(["x"] * n), "c_nationkey": pa.array([i % 25 for i in range(n)], pa.int64()),
                             "c_acctbal": pa.array([0.0] * n), "c_mktsegment": pa.array(["m"] * n)}), f"{tmp_path}/customer.parquet")
    for name in ("site_pages", "area_pages"):
        pages = fx.view(spark, str(tmp_path), name)
        tasks = pages.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert sum(t["count"] for t in tasks) == n and max(t["count"] for t in tasks) < 30_000
        assert pages.select("page_id").distinct().count() == n
    small = fx.view(spark, sf_small, "site_pages")
    assert small.groupBy(F.spark_partition_id()).count().count() == 1
