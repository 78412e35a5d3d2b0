"""The five reports. Each function takes a ledger and returns lazy DataFrames."""
