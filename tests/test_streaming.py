"""The stream's totals equal the batch's."""

from panelwright.sources.panels import hourly
from panelwright.streaming.hourly import hourly_totals

DATA = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    spark.read.parquet(f"{DATA}/events.parquet").write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = hourly_totals(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
    run = stream.writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    run.awaitTermination(120)
    cols = ["wh_id", "sku", "cast(ts_hour as string) h", "cnt"]
    assert sorted(map(tuple, spark.table("hours").selectExpr(*cols).collect())) == sorted(map(tuple, hourly(spark, DATA).selectExpr(*cols).collect()))
