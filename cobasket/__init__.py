"""Co-purchase analytics as PySpark DataFrame operators."""
