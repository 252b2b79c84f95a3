"""The batch operators behind a file stream."""

from conftest import write
from sluice.operators.contracts import PRODUCT_CATALOG_V1
from sluice.streaming import ingest_stream

HDR = b"sku,product_name,category_code,list_price,unit_cost,currency_code\n"


def test_stream_verdicts(spark, tmp_root):
    write(tmp_root, "src/product_catalog/v1/ok.csv", HDR + b"SKU-1,Bottle,OUT,1.00,,EUR\n")
    write(tmp_root, "src/product_catalog/v1/dup.csv", HDR + b"A,x,C,1,,EUR\nA,y,C,1,,EUR\n")
    q = ingest_stream(spark, tmp_root + "/src", PRODUCT_CATALOG_V1, tmp_root + "/out",
                      checkpoint=tmp_root + "/ckpt")
    q.awaitTermination(120)
    got = {r["source_identifier"]: r["state"] for r in spark.read.parquet(tmp_root + "/out/verdicts").collect()}
    assert got == {"product_catalog/v1/ok.csv": "SUCCEEDED", "product_catalog/v1/dup.csv": "BLOCKED"}
    assert spark.read.parquet(tmp_root + "/out/records").count() == 1


def test_a_restart_adds_only_new_files(spark, tmp_root):
    write(tmp_root, "src/product_catalog/v1/one.csv", HDR + b"SKU-1,Bottle,OUT,1.00,,EUR\n")

    def run():
        q = ingest_stream(spark, tmp_root + "/src", PRODUCT_CATALOG_V1, tmp_root + "/out")
        q.awaitTermination(120)
        return [spark.read.parquet(f"{tmp_root}/out/{name}").count() for name in ("verdicts", "records")]

    assert run() == [1, 1]
    assert run() == [1, 1]
    write(tmp_root, "src/product_catalog/v1/two.csv", HDR + b"SKU-2,Cup,OUT,1.00,,EUR\nSKU-3,Mug,OUT,2.00,,EUR\n")
    assert run() == [2, 3]
