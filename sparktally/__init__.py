"""sparktally: rating, review, commerce and frame analyses as PySpark DataFrame jobs."""

__version__ = "0.1.0"
