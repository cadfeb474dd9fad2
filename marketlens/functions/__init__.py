"""Scalar functions (SCA-1..25) built from pyspark.sql.functions, and the fixed label maps."""
