"""Land-use-change emissions as PySpark DataFrame operators."""
