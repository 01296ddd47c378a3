from cohortline.functions import columns, hashing

__all__ = ["columns", "hashing"]
