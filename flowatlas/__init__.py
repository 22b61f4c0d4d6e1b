"""Origin-destination mobility graph analytics as Spark jobs."""
