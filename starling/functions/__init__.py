"""Column in, column out. Built-in Spark expressions only, but for two Arrow functions of the ledger."""
