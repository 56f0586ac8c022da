"""Text formats at the edges: query sets, ranked lists, logs, documents, indexes, records."""
