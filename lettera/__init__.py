"""lettera: literacy-indicator analytics as PySpark DataFrame operators."""

from lettera.model import COUNTRY, MUNICIPALITY, STATE, IndicatorModel, Level

__all__ = ["COUNTRY", "MUNICIPALITY", "STATE", "IndicatorModel", "Level"]
