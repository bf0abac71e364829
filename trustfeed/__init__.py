"""Trust-ranked feed recommendation as Spark DataFrame operators."""
