"""DataFrame operators: format choice, standardisation, dictionaries, substitution, counts."""
