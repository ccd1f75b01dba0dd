"""Trip-record analytics as Spark jobs: landing, bronze, silver, gold, checks, profiles."""
