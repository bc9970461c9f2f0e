"""lumbung: regional supply-risk analytics as Spark DataFrame jobs."""
