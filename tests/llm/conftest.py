import pytest


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from weirgauge.llm.shipping import ship

    ship(spark)
