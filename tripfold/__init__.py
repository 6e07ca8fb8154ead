"""Monthly record feeds on PySpark: ingest, validate, quarantine, model, check.

Every operator takes DataFrames and returns a DataFrame.  Nothing in the package
defines a UDF over records; Catalyst sees one declarative plan from scan to sink.
"""
