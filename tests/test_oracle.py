"""Every query of the library that SQL can express gives the rows of its SQL."""

import pytest
from compare import duck_rows, spark_rows

from cairn.plans import analytics, records, transfers  # noqa: F401
from cairn.plans.tables import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(ORACLE[name], sf_dir)
