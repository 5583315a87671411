"""fraudmart: a Spark-native daily warehouse load and fraud data mart.

Layout
------
``schemas``      canonical StructTypes, keys and column lists
``session``      session builder and the shared checkpoint folder
``fixtures``     warehouse-shaped frames derived from the driver tables
``functions``    scalar column helpers (Oracle-compatible strings, stamps)
``sources``      source tables, text and workbook feeds, drop-file listing
``operators``    capture, SCD1 upsert/delete, facts, watermarks, report, files
``plans``        storage with atomic publish, and the daily pipeline
``streaming``    optional stream entry for the transactions feed

Every operator is a function ``DataFrame -> DataFrame``; only ``plans`` touches
storage.
"""

__version__ = "0.1.0"
