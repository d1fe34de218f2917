"""tidewater: incremental ELT and activation operators on Spark.

Every operator is a pure ``DataFrame -> DataFrame`` function; writing is a
separate, thin sink step. See ``README.md`` for the map of operators.
"""

from tidewater.session import build_session, configure_session, scratch_path

__all__ = ["build_session", "configure_session", "scratch_path"]
