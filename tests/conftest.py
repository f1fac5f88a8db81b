import pytest

from sensorgraph.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()
