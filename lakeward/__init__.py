"""lakeward — layered (raw → cleansed → star schema) tables and their audits on Apache Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so the same code runs on batch and on Structured Streaming input.
"""

from lakeward.session import build_session, work_dir, fresh_dir  # noqa: F401

__all__ = ["build_session", "work_dir", "fresh_dir"]
