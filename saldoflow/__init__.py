"""saldoflow: finance ledger analytics as Spark DataFrame operators."""
