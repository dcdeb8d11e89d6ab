"""folio: document-corpus operators for Spark."""
