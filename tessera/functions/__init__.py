"""Column functions: text, hashes and ids, vectors, vocabularies."""
