"""People analytics on Spark: landing, drift, quality and workforce models as DataFrame jobs."""
