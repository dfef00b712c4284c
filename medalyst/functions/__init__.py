"""Column helpers (``columns``) and tail probabilities (``distributions``)."""
