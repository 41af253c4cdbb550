"""Plans: whole procedures put together from operators."""
