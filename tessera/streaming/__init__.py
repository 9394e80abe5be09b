from .score import FittedPreparation, fit_preparation, score_stream

__all__ = ["FittedPreparation", "fit_preparation", "score_stream"]
