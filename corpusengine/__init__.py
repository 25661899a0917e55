"""Text analytics over document collections, expressed as Spark DataFrame plans."""
