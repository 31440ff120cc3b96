"""tidewell: e-commerce ELT and analytics written as plain Spark DataFrame jobs."""
