import pytest

from threshline.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus=4, memory="3g", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    return s
