from tierline.sinks.warehouse import Warehouse

__all__ = ["Warehouse"]
