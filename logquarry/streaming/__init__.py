"""Lines as messages for a topic."""
