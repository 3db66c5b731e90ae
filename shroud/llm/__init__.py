"""Operators of a training-data pipeline over text, media and crawl tables."""
