"""Competition-results analytics expressed as Spark DataFrame plans."""
