"""Usage events as a stream: decoding, enrichment, sinks and score lookup."""
