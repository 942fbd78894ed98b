"""martforge: a retail data-mart engine on Spark DataFrames.

Layers: ``sources`` (scans, ingest, sinks), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame building blocks),
``plans`` (the star model, layered loads, daily jobs, registered queries) and
``streaming`` (Structured Streaming forms).
"""

__version__ = "0.1.0"
