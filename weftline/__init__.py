"""weftline: record linkage as Spark DataFrame programs."""
