"""Order-to-revenue data jobs and everyday dataflow operators as Spark DataFrame plans."""
