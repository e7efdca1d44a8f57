"""Training-data operators: the corpus operators and their registered queries.

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds its
queries when the folder is present."""
