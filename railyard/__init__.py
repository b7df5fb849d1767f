"""railyard: a PySpark lakehouse toolkit for public freight and trade statistics."""
