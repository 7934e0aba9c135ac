"""DataFrame -> DataFrame operators."""

from . import answers, dedupe, discover, harmonize, metrics, multiselect, quality

__all__ = ["answers", "dedupe", "discover", "harmonize", "metrics", "multiselect", "quality"]
