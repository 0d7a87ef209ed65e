"""racecast: race-outcome analytics written as PySpark DataFrame operators."""
