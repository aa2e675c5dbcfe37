"""chronopanel: time-panel analytics as Spark DataFrame operators.

A panel is a table of measures keyed by (period, entity). Every public
operator takes DataFrames and returns a DataFrame; the work is planned by
Catalyst and runs on executors. Python enters only in the few model
operators that solve small per-group systems on aggregated data.
"""

__version__ = "0.1.0"
