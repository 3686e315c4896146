"""N-gram language models of source code as Spark DataFrame jobs."""
