import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from oracle import session

    return session("4")


@pytest.fixture(scope="session")
def harvest(spark):
    from sparkyield.sources.fixtures import harvest

    return harvest(spark, SF).cache()


@pytest.fixture(scope="session")
def person_day(spark):
    from sparkyield.sources.fixtures import person_day

    return person_day(spark, SF).cache()


@pytest.fixture(scope="session")
def pred(spark):
    from sparkyield.sources.fixtures import pred

    return pred(spark, SF).cache()
