"""Layered batch refinement of record files on PySpark: raw, clean, enriched, marts."""
