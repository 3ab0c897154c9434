"""rivulet: a PySpark-native library of batch and streaming operators.

Every operator is a function from DataFrame(s) to a DataFrame, written with
the DataFrame / SQL API so that Catalyst plans it and Tungsten runs it.
"""

from rivulet.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
