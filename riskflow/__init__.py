"""riskflow: transaction-fraud analytics on Spark DataFrames.

Sub-packages: ``functions`` (column expressions), ``sources`` (scans, sinks, fixtures),
``operators`` (profiling, cleaning, features, encoders, selection, splits, metrics, models,
explanation, scoring), ``plans`` (pipeline composition, query catalog, SQL oracle),
``streaming`` (stream scoring).
"""

from riskflow.settings import DEFAULT, Settings

__all__ = ["DEFAULT", "Settings"]
__version__ = "0.1.0"
