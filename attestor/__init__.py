"""attestor: document-evidence reconciliation on PySpark."""
