"""The check queries over the test tables: Spark plans and their plain-SQL oracles."""
