"""Training-data operators on whole tables: archives, tokens, neighbours, mixing, filters."""
