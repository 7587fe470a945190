"""Plans: batches of transitions over many tables, and the registered queries."""
