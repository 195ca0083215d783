"""inkmill: dataset curation for language-model training text, as Spark plans."""
