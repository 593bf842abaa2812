"""emporia: a Spark-native retail analytics engine.

Change-log and page-log records become fact and dimension DataFrames,
which are joined, marked (first visits, returning users, retractions),
aggregated in tumbling event-time windows, scored and screened. Every
operator takes and returns a DataFrame; the same functions serve batch
reads and Structured Streaming wherever Spark allows.
"""

from emporia.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
