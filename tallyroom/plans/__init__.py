from .build import build_marts, read_mart, refresh_revenue, refresh_revenue_months
from .checks import standard_checks
from .models import MODEL_NAMES, Models

__all__ = ["MODEL_NAMES", "Models", "build_marts", "read_mart", "refresh_revenue", "refresh_revenue_months", "standard_checks"]
