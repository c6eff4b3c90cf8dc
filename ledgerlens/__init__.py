"""Trade-event analytics on PySpark: operators, sources, plans and streams."""
