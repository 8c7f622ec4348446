"""martloom: documents to typed raw tables to daily marts, as Spark DataFrame jobs."""
