"""Reports over a signed income/expense ledger, written as Spark DataFrames."""
