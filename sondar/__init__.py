"""Sondar: inventory, profile and watch the tables a Spark session can read.

Every operator takes DataFrames and returns DataFrames; only
:func:`sondar.plans.scan.scan_tables` drives several jobs.
"""

__version__ = "0.1.0"
