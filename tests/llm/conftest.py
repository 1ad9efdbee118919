from __future__ import annotations

import pytest

from adtally.llm.common import tuned


@pytest.fixture(autouse=True)
def _tuned(spark):
    tuned(spark)
