"""The streaming snapshot load picks up each dated folder once."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tillwise.sources import testdata, write_snapshot
from tillwise.streaming.snapshots import start_snapshot_load


def test_stream_loads_each_day_once(spark, scratch):
    root = f"{scratch}/landing"
    sink = f"{scratch}/table"
    stores = testdata.derive(spark, SF_SMALL, "stores")
    write_snapshot(stores, root, "stores", "2001-08-01", "csv")
    q = start_snapshot_load(spark, root, "stores", sink=sink)
    q.awaitTermination(120)
    first = spark.read.parquet(sink)
    assert first.count() == 25
    write_snapshot(stores.where(F.col("store_id") < 5), root, "stores", "2001-08-02", "csv")
    q = start_snapshot_load(spark, root, "stores", sink=sink)
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert rows(out.groupBy("file_received_date").count()) == [
        (__import__("datetime").date(2001, 8, 1), 25), (__import__("datetime").date(2001, 8, 2), 5)]
    assert out.where(F.col("region").isin("NE", "North-East")).select(
        F.collect_set("new_region")).first()[0] == ["Northeast"]
