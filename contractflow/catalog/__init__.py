"""All contracts of the mesh, by name."""

from ..contract import Contract
from . import marketing, marketplace, operations, payments, reference, shared

_ALL = (
    *marketplace.BRONZE, *marketplace.SILVER, *marketplace.GOLD,
    *payments.BRONZE, *payments.SILVER, *payments.GOLD,
    *marketing.BRONZE, *marketing.SILVER, *marketing.GOLD,
    *operations.BRONZE, *operations.SILVER, *operations.GOLD,
    *reference.BRONZE, *reference.SILVER, *reference.GOLD,
    *shared.GOLD,
)

# The source systems of a domain; the first is that of tables which name none.
SYSTEMS = {
    "marketplace": ("rideflow",), "payments": ("stripe",), "marketing": ("google_ads", "google_analytics", "hubspot", "meta_ads"),
    "operations": ("zendesk", "checkr", "twilio"), "reference": ("internal",), "shared": ("shared",),
}


def _system(contract: Contract) -> str:
    systems = SYSTEMS[contract.domain]
    return next((s for s in systems if f"_{s}_" in contract.name), systems[0])


CONTRACTS: dict[str, Contract] = {c.name: c.with_(system=_system(c)) for c in _ALL}

__all__ = ["CONTRACTS", "SYSTEMS"]
