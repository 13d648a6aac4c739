"""Training-data pipeline operators: ten independent operators over documents,
pages and embeddings. Nothing outside this package imports it."""
