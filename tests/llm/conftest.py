import pytest


@pytest.fixture(autouse=True, scope="session")
def shared_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
