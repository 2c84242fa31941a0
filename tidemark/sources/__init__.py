"""Sources: canonical views over the driver tables, files, feed normalisers."""
