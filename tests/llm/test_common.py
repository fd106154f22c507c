import pytest

from aeromill.llm import common


def test_written_tables_can_be_released(spark):
    common.release(spark)
    df = common.materialise(spark.range(5), "five")
    assert df.count() == 5 and common.release(spark) == 1 and common.release(spark) == 0
    with pytest.raises(Exception, match="(?i)not exist|not found"):
        spark.read.parquet(df.inputFiles()[0]).count()


def test_null_ids_match(spark):
    rows = spark.createDataFrame([(None,), (3,)], "doc_id int").select(common.id_key("doc_id").alias("k")).collect()
    assert [r.k for r in rows] == [common.NULL_ID, 3]
