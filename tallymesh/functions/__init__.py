"""Scalar and array functions that Spark lacks, for use in pandas UDFs and on the driver."""

from ..operators.metrics import chi2_tail, simpson
from ..operators.neighbors import bandwidths
from ..operators.rogue import adjust, loess, upper_tail

__all__ = ["adjust", "bandwidths", "chi2_tail", "loess", "simpson", "upper_tail"]
