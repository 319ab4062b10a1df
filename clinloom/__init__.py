"""clinloom: clinical-operations ELT as Spark DataFrame jobs."""
