"""Operators of a training-data pipeline (deduplication, language, quality,
mixing, sharding, packing). Nothing else in kestrel imports this package."""
