"""Transit-feed lake on PySpark: decode, flatten, summarise, verify, publish, retain."""

from transitlake.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
