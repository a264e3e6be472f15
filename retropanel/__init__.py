"""Energy-retrofit market analytics as Spark DataFrame operators."""
