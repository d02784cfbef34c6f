"""vigil: Spark-native news-story monitoring.

Many standing searches ("projects") are matched, scored and reported on
at once as DataFrame jobs; a project is a column, never a driver loop.
"""

from vigil.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
