import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))

import compare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from weirgauge.session import prepare

    return prepare(compare.spark_session())


@pytest.fixture(scope="session")
def sf_dir():
    return str(compare.DATA / "sf0.001")


@pytest.fixture(scope="session")
def db(sf_dir):
    return compare.database(sf_dir)
