"""Multi-channel retail lakehouse analytics on Spark.

Layers: ``sources`` and ``streaming`` bring raw drops in, ``operators`` are pure
DataFrame -> DataFrame steps, ``sinks`` publish tables, ``plans`` chain them into the
bronze, silver, gold and feature jobs.
"""
