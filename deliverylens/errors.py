"""Errors raised by the checks of this package."""


class DeliveryLensError(RuntimeError):
    """Base class."""


class GrainError(DeliveryLensError):
    """A table does not have one row per key."""


class LeakageError(DeliveryLensError):
    """A feature is not known at the prediction point."""


class SplitError(DeliveryLensError):
    """A chronological split does not hold."""


class DataQualityError(DeliveryLensError):
    """A quality rule failed."""


class BundleError(DeliveryLensError):
    """Saved model state is missing or does not fit together."""


class ScoringError(DeliveryLensError):
    """Orders cannot be scored."""


class OrderFileError(DeliveryLensError):
    """An order file cannot be read."""


class FitError(DeliveryLensError):
    """A model did not reach its optimum."""
