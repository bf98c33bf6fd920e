"""Stream and table analytics as PySpark DataFrame functions."""
