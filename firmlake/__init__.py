"""firmlake: company-data ingestion, derived lists and reports as Spark DataFrame plans."""
