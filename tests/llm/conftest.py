import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from inputs import DOCS  # noqa: E402


@pytest.fixture
def docs(spark):
    """Builds a documents table, with columns whose names operators might want for themselves."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), 1, "k", "b", 2, 3) for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make
