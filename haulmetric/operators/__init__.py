"""DataFrame -> DataFrame operators, usable on batch frames and, where noted, streams."""
