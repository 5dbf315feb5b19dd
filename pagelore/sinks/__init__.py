"""Writers: sentence TSV, entity JSON, correction records, cache."""
