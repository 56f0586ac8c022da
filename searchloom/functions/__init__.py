"""Column expressions: URLs, HTML anchors, words, and Arrow-batched model calls."""
