import pytest

from marlstone.session import drop_materialized, session


@pytest.fixture(scope="session")
def spark():
    made = session("tests", 4, spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    yield made
    drop_materialized(made)
