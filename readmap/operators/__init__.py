"""DataFrame operators: pairing, barcode joins, counters, order and layout."""
