"""Record quality, reconciliation and operational reporting on Spark DataFrames.

Every job takes DataFrames and returns DataFrames; columns, keys and rules are
parameters.  Files appear only in :mod:`rowsmith.sources`.
"""

__version__ = "0.1.0"
