"""The operators run on the star-schema test tables, each with an independent SQL twin."""
