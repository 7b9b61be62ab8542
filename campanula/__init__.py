"""campanula: marketing and customer analytics as Spark DataFrame operators.

Every public operator takes DataFrames (or Columns) and returns a DataFrame
(or Column); the heavy lifting is left to Catalyst and Tungsten.
"""

from campanula.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
