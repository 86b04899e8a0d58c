"""tableflow: moving, reconciling and quality-checking tables with plain PySpark."""
