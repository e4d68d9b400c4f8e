"""Every registered query against its oracle."""

import pytest

from daymill.queries import REGISTRY
from tests.oracle import differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, name):
    assert differences(spark, REGISTRY[name], SF_DIR) == []
