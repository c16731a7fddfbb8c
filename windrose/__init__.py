"""windrose: event-window analytics expressed as Spark DataFrame plans.

Every public function takes and returns DataFrames or Columns, so the same
code serves batch tables and Structured Streaming frames.
"""

from windrose.session import build_session, prepare_session, checkpoint_dir

__all__ = ["build_session", "prepare_session", "checkpoint_dir"]
