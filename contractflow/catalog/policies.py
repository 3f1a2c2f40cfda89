"""Service levels, budgets, retention and erasure by domain. All values are fixed values."""

from ..operators.service_levels import Levels
from ..operators.slo import AnomalySlo, Budget, QualitySlo, RowCountSlo, ScheduleSlo

FRESHNESS_MINUTES = {
    "marketplace": {"bronze": 30, "silver": 120, "gold": 999_999},
    "payments": {"bronze": 60, "silver": 240},
    "marketing": {"bronze": 120, "silver": 360},
    "operations": {"bronze": 60, "silver": 240},
    "reference": {"bronze": 1440, "silver": 1440, "gold": 999_999},
    "shared": {"gold": 999_999},
}
SOURCE_DELAY_MINUTES = {
    "marketplace": {"bronze": 60, "silver": 180},
    "payments": {"bronze": 120, "silver": 300},
    "marketing": {"bronze": 240, "silver": 480},
    "operations": {"bronze": 120, "silver": 360},
    "reference": {"bronze": 2880},
}

ROW_COUNTS = {
    "marketplace": {"bronze": RowCountSlo(1, 500_000), "silver": RowCountSlo(10, 500_000)},
    "payments": {"bronze": RowCountSlo(1, 200_000), "silver": RowCountSlo(1, 200_000)},
    "marketing": {"bronze": RowCountSlo(1, 100_000), "silver": RowCountSlo(1, 100_000)},
    "operations": {"bronze": RowCountSlo(1, 100_000), "silver": RowCountSlo(1, 100_000)},
    "reference": {"bronze": RowCountSlo(1, 100_000, warn_only=True), "silver": RowCountSlo(1, 100_000, warn_only=True)},
    "shared": {"gold": RowCountSlo(1, None, warn_only=True)},
}
ANOMALY = AnomalySlo()
ANOMALY_DOMAINS = ("marketplace", "payments", "marketing", "operations")
ANOMALY_LAYERS = ("bronze", "silver")
SCHEDULED_ENVIRONMENTS = ("dev", "prod", "staging")
CURRENCY = "GBP"


def _severity(critical: float, high: float, medium: float, low: float) -> dict[str, float]:
    return {"critical": critical, "high": high, "medium": medium, "low": low}


QUALITY = {
    "marketplace": QualitySlo(0.92, 0.08, _severity(0.999, 0.99, 0.95, 0.9)),
    "payments": QualitySlo(0.99, 0.01, _severity(0.9999, 0.999, 0.99, 0.95)),
    "marketing": QualitySlo(0.95, 0.05, _severity(0.999, 0.99, 0.95, 0.90)),
    "operations": QualitySlo(0.95, 0.05, _severity(0.999, 0.99, 0.95, 0.90)),
    "reference": QualitySlo(0.999, 0.001, {"critical": 1.0, "high": 0.999}),
    "shared": QualitySlo(0.99, 0.01, {}),
}
SCHEDULE = {
    "marketplace": ScheduleSlo("04:00", "05:00", 30, 60),
    "payments": ScheduleSlo("05:00", "06:00", 20, 45),
    "marketing": ScheduleSlo("06:00", "07:00", 30, 60),
    "operations": ScheduleSlo("06:30", "07:30", 25, 50),
    "reference": ScheduleSlo("03:00", "03:30", 30, 60),
    "shared": ScheduleSlo("05:30", "06:00", 30, 60),
}
BUDGET = {
    "marketplace": Budget(40, 200, 600),
    "payments": Budget(25, 125, 400),
    "marketing": Budget(20, 100, 300),
    "operations": Budget(15, 75, 250),
    "reference": Budget(5, 25, 75),
    "shared": Budget(10, 50, 150),
}
RETENTION = {
    "marketplace": {"bronze": "P7D", "silver": "P90D", "gold": "P7Y"},
    "reference": {"bronze": "P30D", "silver": "P7Y", "gold": "P7Y"},
    "shared": {"gold": "P7Y"},
}


LEVELS = {
    (domain, layer): Levels(
        freshness_minutes=FRESHNESS_MINUTES[domain].get(layer),
        source_delay_minutes=SOURCE_DELAY_MINUTES.get(domain, {}).get(layer),
        row_count=ROW_COUNTS[domain].get(layer),
        anomaly=ANOMALY if domain in ANOMALY_DOMAINS and layer in ANOMALY_LAYERS else None,
        quality=QUALITY[domain], schedule=SCHEDULE[domain], environments=SCHEDULED_ENVIRONMENTS, budget=BUDGET[domain])
    for domain in QUALITY for layer in ("bronze", "silver", "gold")
}
