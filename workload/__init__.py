"""The registered queries over the driver's tables, and their SQL counterparts."""

from workload import cleaning, describing, files, modelling, segmenting
from workload.tables import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "describing", "files", "modelling", "segmenting"]
