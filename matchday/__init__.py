"""PySpark library for match results: landing, team form, season points, streaming upkeep."""
