"""ferry: extract-and-report data work as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (use it through
``df.transform(op, **kwargs)``); sources return DataFrames and sinks take
them. Nothing here collects rows to the driver.
"""

from ferry.session import build_session, scratch_path, scratch_root

__all__ = ["build_session", "scratch_path", "scratch_root"]
