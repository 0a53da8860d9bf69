"""Time-series metric monitoring as plain DataFrame operators on Spark."""
