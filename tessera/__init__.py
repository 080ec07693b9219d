"""User-written Python functions in Spark SQL and DataFrames, under one strict contract.

    from tessera import Engine, types as t
    engine = Engine(spark)
    engine.register_scalar("net", lambda price, off: price * (1 - off), args=[t.F64, t.F64], returns=t.F64)
    spark.sql("SELECT sum(net(l_extendedprice, l_discount)) FROM lineitem")
"""

from . import types
from .engine import Engine
from .functions.values import Bits, Interval, Union
from .sources.table import TableStream

__all__ = ["Bits", "Engine", "Interval", "TableStream", "Union", "types"]
