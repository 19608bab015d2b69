import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from clickloom.llm.queries import SQL
from compare import connect, difference
from conftest import SMALL


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(SMALL), SMALL, name) is None
