"""Dashboard queries and the batch load flow."""
