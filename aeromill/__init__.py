"""aeromill: a PySpark-native engine for pollution-sensor time series.

Sub-packages
------------
functions   Catalyst column builders (index, units, quality flags, local time).
operators   DataFrame -> DataFrame operators (clean, gold, dims, validation, alerts, ML).
sources     readers and deterministic generators.
plans       named SQL reports, end-to-end batch plans and registered queries.
streaming   Structured Streaming twins of the raw, alert and dedupe paths.
"""

__version__ = "0.1.0"
