"""tagstream: telemetry analytics as Spark DataFrame operators.

Readings are a tall table ``(source_id, device_id, tag_name, ts, value)``.
Every operator takes and returns DataFrames so Catalyst plans the whole
pipeline; Python runs only inside streaming state functions.
"""

from tagstream.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
