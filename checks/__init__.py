"""Every operator run on the shared test tables, next to an independent SQL statement."""
