"""flowlens: network-flow log analytics on Spark.

Sub-packages: ``functions`` (column expressions), ``operators`` (DataFrame
operators: normalise, windows, reports, views), ``sources`` and ``sinks``,
``streaming`` (the Structured Streaming jobs) and ``plans`` (batch jobs and
the registered checks). See README.md.
"""

__version__ = "0.1.0"
