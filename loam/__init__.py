"""loam: a Spark-first medallion engine for semi-structured text records."""
