"""Part of lexalign, a Spark-first entity-resolution and text-analytics engine."""
