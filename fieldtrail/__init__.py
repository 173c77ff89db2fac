"""fieldtrail: field-level change history for evolving records, as Spark DataFrame operators."""
