"""Booking analytics on Spark: reports, checks and change auditing as DataFrame operators."""

__version__ = "0.1.0"
