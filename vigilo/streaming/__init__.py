"""Streaming entry point.

The reference has no streaming operators (no watermarks, windows or state);
its "real-time" dashboard reads a table rebuilt at start-up. The one
streaming piece here re-runs that rebuild when new presence files land.
"""

from vigilo.streaming.refresh import start_profile_refresh

__all__ = ["start_profile_refresh"]
