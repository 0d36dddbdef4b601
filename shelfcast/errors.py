"""One exception per layer, raised under the same conditions as the model pipeline."""


class BronzeLandingError(RuntimeError):
    """Change events cannot be landed into the bronze table."""


class SilverTransformError(RuntimeError):
    """Bronze events cannot be turned into silver events."""


class GoldTransformError(RuntimeError):
    """Silver events cannot be aggregated into gold demand."""


class BaselineForecastError(RuntimeError):
    """The baseline forecast cannot be evaluated."""


class DataQualityError(RuntimeError):
    """A blocking data-quality suite failed; the target table was not written."""
