"""Text and table analytics written directly on PySpark."""
