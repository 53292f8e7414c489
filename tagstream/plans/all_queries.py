"""Import every module that registers queries."""

from tagstream.plans import registry  # noqa: F401
from tagstream.plans import series_queries  # noqa: F401
from tagstream.plans import rule_queries  # noqa: F401
from tagstream.plans import alert_queries  # noqa: F401
from tagstream.plans import decode_queries  # noqa: F401
from tagstream.plans import stream_queries  # noqa: F401
from tagstream.plans import host_queries  # noqa: F401
from tagstream.plans import lifecycle_queries  # noqa: F401
