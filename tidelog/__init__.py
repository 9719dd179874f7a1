"""tidelog: analytics over topic logs, written as plain Spark DataFrame transformations.

A topic is a table of messages with a total order (``bookmark``).  Reads, writes, work queues and
windows are functions that take DataFrames and return DataFrames; the same function serves a batch
read and a structured stream wherever Spark allows it.
"""

from tidelog.session import build_session, scratch_folder

__all__ = ["build_session", "scratch_folder"]
