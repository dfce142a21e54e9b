"""Commerce-event analytics as PySpark DataFrame functions, for tables and for streams."""
