"""Every registered query of the library's own operators against its SQL."""

import pytest

from carrel.plans import registry
from tests.compare import check

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_agrees_with_sql(spark, name):
    sql = registry.oracle_sql()
    assert name in sql
    check(spark, SF, registry.queries()[name], sql[name])
