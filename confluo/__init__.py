"""confluo: conform multi-system landed tables into a governed star and
answer metric questions on it, expressed entirely as Spark DataFrames."""

from confluo.config import StarConfig

__all__ = ["StarConfig"]
__version__ = "0.1.0"
