"""Group analytics on Spark: landing files to conformed entities to reporting marts."""
