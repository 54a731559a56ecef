"""Regional indicators from irregular public-sector files, as Spark plans.

``sources`` read and write, ``functions`` are column expressions, ``operators``
are DataFrame building blocks, ``plans`` assemble conformed tables, wide
indicator tables and serving queries, ``streaming`` ingests incrementally.
"""
