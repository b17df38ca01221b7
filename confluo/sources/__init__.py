from confluo.sources.binding import Landed

__all__ = ["Landed"]
