"""DataFrame -> DataFrame operators, for batch frames and, where noted, streaming ones."""
