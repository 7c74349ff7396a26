"""Training-data operators: ten table-level operators and the corpus pipeline
built from them. Nothing else in the library imports this subpackage."""
