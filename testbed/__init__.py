"""Maps the test tables onto the logs and dimensions the library reads, and registers the queries."""

from testbed import operators, reports, scaled  # noqa: F401
from testbed.registry import ORACLES, QUERIES  # noqa: F401
