import pytest

from twingraph.llm.common import share_package


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    share_package(spark)
