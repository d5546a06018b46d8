"""Tables of ``cases`` as data frames."""

from __future__ import annotations

import pytest
from cases import ROWS, table

from tallycart.llm.common import share_package


@pytest.fixture(scope="session")
def docs(spark):
    share_package(spark)
    return table(spark, ROWS)


@pytest.fixture(scope="session")
def no_docs(spark):
    share_package(spark)
    return table(spark, [])
