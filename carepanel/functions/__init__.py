"""Column-level helpers shared by the operators. Nothing here starts a Spark job."""
