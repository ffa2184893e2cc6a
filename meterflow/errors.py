class DataValidationError(ValueError):
    """The data, or a parameter describing it, breaks a stated rule."""


class QualityGateError(ValueError):
    """A trained model misses its quality thresholds."""
