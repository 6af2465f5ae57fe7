"""wattledger: Spark DataFrame operators for electricity metering and billing."""

from wattledger.settings import Settings

__all__ = ["Settings"]
