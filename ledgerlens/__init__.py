"""ledgerlens: sales exports to ranked business alerts, expressed as Spark DataFrame plans."""

from ledgerlens.config import Params

__all__ = ["Params"]
__version__ = "0.1.0"
