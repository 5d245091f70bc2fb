"""DataFrame operators: transform, bookmark, discovery, validation, pages, messages, metrics."""
