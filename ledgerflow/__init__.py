"""ledgerflow: dual-mode (batch + Structured Streaming) ledger and behaviour analytics on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark SQL expressions, so
Catalyst can push filters into the scan, prune columns and plan the shuffles. Streaming runners in
:mod:`ledgerflow.streaming` wrap the same functions for ``readStream`` inputs.
"""

__version__ = "0.1.0"
