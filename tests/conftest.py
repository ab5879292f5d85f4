import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE.parent), str(HERE)]


@pytest.fixture(scope="session")
def spark():
    from trajloom.session import local_session

    return local_session(8, **{"spark.sql.shuffle.partitions": "4"})


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF
