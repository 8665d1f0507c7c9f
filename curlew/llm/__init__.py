"""Training-data operators: token output, licence lookup, WARC archives,
benchmark decontamination, nearest neighbours, secret scan, quality sampling,
near-duplicate classes, URL reputation and source mixing. Nothing else in the
library imports this subpackage; ``queries.py`` holds its registered queries."""
