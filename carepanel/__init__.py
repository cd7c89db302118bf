"""Clinical and population-health analytics as PySpark DataFrame operators."""
