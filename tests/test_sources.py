"""Source helpers."""

from jobsight.sources.fixture import vacancy_records
from jobsight.sources.tables import read_table
from tests.conftest import SF_MID


def test_read_table_prunes_columns(spark):
    df = read_table(spark, SF_MID, "orders", ["o_orderkey", "o_orderdate"])
    assert df.columns == ["o_orderkey", "o_orderdate"]


def test_records_have_one_plan_whatever_the_splits(spark):
    def shape(split_bytes):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
        try:
            plan = vacancy_records(spark, SF_MID)._jdf.queryExecution().sparkPlan().toString()
            return [line.strip(" +-:").split(" ")[0].split("#")[0] for line in plan.split("\n")]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)

    assert shape("128m") == shape("8k")
