"""Trip-record pipelines and model monitoring as Spark DataFrame jobs."""
