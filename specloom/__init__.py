"""specloom: equipment-datasheet analytics as Spark DataFrame jobs."""
