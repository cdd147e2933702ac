"""Message topics, replayed messages and stored tables."""
