"""rivulet: keyed-record stream operators and live-table maintenance on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from Spark SQL expressions, so that one definition
serves a batch DataFrame and, wherever Spark allows it, a Structured
Streaming DataFrame.
"""

from rivulet.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
