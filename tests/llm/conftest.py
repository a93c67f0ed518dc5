import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from shared import SCHEMA, corpus


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "en" if d and d % 2 else None, "s", None, "a", "b", "c", "d") for d, t in corpus()], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
