"""Call analytics, entity preparation and constraint audits as Spark DataFrame operators."""
