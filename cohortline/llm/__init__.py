"""Operators of a training-data pipeline: deduplication, packing, decontamination, licences, secrets, quality, HTML."""
