from .mart import Mart

__all__ = ["Mart"]
