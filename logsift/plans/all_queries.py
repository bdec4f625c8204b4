"""Import every query module so the registry is complete."""

from logsift.plans import profile_queries  # noqa: F401
from logsift.plans import clean_queries  # noqa: F401
from logsift.plans import label_queries  # noqa: F401
from logsift.plans import dashboard_queries  # noqa: F401
from logsift.plans import source_queries  # noqa: F401
from logsift.plans import stream_queries  # noqa: F401
from logsift.plans import coverage_queries  # noqa: F401
