"""dayledger: daily customer ledgers and the analytics around them, as PySpark jobs."""
