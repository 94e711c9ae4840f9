"""Table catalog, classification rules and vocabularies: data, not logic."""
