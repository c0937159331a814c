"""terrace: zonal statistics and training-data preparation as Spark plans."""
