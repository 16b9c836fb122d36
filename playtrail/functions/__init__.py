from . import codes, coerce, hashing, times

__all__ = ["codes", "coerce", "hashing", "times"]
