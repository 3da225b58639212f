from tallyweb.sources.listing_pages import part_pages
from tallyweb.streaming.stream import product_table, stream_products

SF = "/root/testdata/sf0.001"


def test_stream_is_batch_and_redelivery_adds_nothing(spark, tmp_path):
    part = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey < 60")
    part_pages(part).coalesce(1).write.parquet(f"{tmp_path}/pages")
    out = f"{tmp_path}/out"
    stream_products(spark, f"{tmp_path}/pages", out, f"{tmp_path}/c1", max_files=1).awaitTermination()
    first = product_table(spark, out).rows().count()
    stream_products(spark, f"{tmp_path}/pages", out, f"{tmp_path}/c2").awaitTermination()
    assert first == product_table(spark, out).rows().count() == 60
