"""All registered queries; importing the families registers them."""

from tidelog.plans import queues, reads, sequences, shapes, streams, windows, writes
from tidelog.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "queues", "reads", "sequences", "shapes", "streams", "windows", "writes"]
