"""The queries of the library's operators, with the SQL they are held against."""

import scribemill.plans.files  # noqa: F401 - registers its queries
from scribemill.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
