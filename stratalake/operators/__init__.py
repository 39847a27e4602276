"""Pure ``DataFrame -> DataFrame`` operators."""
