from confluo.functions.dates import (date_key, parse_iso_timestamp, parse_text_date,
                                     text_date_key)
from confluo.functions.text import initcap_words, is_blank, lacks_all, normalise, not_blank

__all__ = ["date_key", "parse_iso_timestamp", "parse_text_date", "text_date_key",
           "initcap_words", "is_blank", "lacks_all", "normalise", "not_blank"]
