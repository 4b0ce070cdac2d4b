"""Column functions: URLs, scores, texts, JSON, times, and the fixed lists that they use."""
