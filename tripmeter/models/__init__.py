"""Features, preprocessing, training, scoring and artifacts."""
