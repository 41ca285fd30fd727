"""Views kept current as observations arrive."""
