"""Column expressions (built-in Spark functions only)."""

from .bands import BandSpec, band_anomaly, band_order, first_amount
from .columns import as_col, clean_text, is_selected, not_blank, safe_col, tolerant_int, tolerant_long
from .numeric import percent
from .text import alias, classify, ordered_rules

__all__ = [
    "BandSpec", "band_anomaly", "band_order", "first_amount",
    "as_col", "clean_text", "is_selected", "not_blank", "safe_col", "tolerant_int", "tolerant_long",
    "percent", "alias", "classify", "ordered_rules",
]
