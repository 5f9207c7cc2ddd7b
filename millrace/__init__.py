"""millrace: a PySpark-native engine that refines web text into training records."""
