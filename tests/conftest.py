from __future__ import annotations

import pytest

from rowsmith.session import configure
from tests.contract import session


@pytest.fixture(scope="session")
def spark():
    """A session for small tables: few partitions and no generated code."""
    spark = configure(session("4"))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield spark
    spark.stop()
