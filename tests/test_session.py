import pytest

from lectern.session import scratch_dir


class Settings(dict):
    """A session that has only settings."""

    @property
    def conf(self):
        return self


CLUSTER = "spark://host:7077"


def test_scratch_lies_in_the_shared_folder():
    spark = Settings({"spark.checkpoint.dir": "hdfs://a/b/", "spark.master": CLUSTER, "spark.sql.warehouse.dir": "file:/w"})
    assert scratch_dir(spark).startswith("hdfs://a/b/") and scratch_dir(spark) != scratch_dir(spark)


@pytest.mark.parametrize("warehouse", ["file:/w", "/w", "file:///w"])
def test_a_local_warehouse_is_refused_on_a_cluster(warehouse):
    spark = Settings({"spark.sql.warehouse.dir": warehouse, "spark.master": CLUSTER})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(spark)
    assert scratch_dir(Settings(spark, **{"spark.master": "local[8]"})).startswith(warehouse + "/_scratch/")


def test_a_shared_warehouse_will_do():
    spark = Settings({"spark.sql.warehouse.dir": "hdfs://a/w", "spark.master": CLUSTER})
    assert scratch_dir(spark).startswith("hdfs://a/w/_scratch/")
