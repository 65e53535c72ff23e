"""Every registered check is SQL that DuckDB can plan."""

import pytest

from quizlake.catalog import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_check_parses(duck, name):
    duck.execute(f"explain {ORACLES[name]}")
