from .expressions import (cut, hash_key, nan_string, rnd, safe_div, signed_log1p,
                          numeric_columns, string_columns)
from .features import add_custom_features

__all__ = ["cut", "hash_key", "nan_string", "rnd", "safe_div", "signed_log1p",
           "numeric_columns", "string_columns", "add_custom_features"]
