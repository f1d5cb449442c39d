"""Result sinks: append with run stamp, versioned replace, idempotent foreachBatch writer."""
