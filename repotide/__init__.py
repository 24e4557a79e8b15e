"""Repository-activity analytics as PySpark DataFrame operators and streams."""
