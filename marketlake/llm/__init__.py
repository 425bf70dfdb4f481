"""Training-data operators: near-duplicates, tokenisation, fingerprints, secrets,
scoring, chat formatting, mixing, quality and language.

Nothing else in the library imports this subpackage.  `queries.QUERIES` holds
one registered query per operator.
"""
