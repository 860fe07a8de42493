"""Curation of datasets with PySpark: DataFrame-to-DataFrame operators."""
