from quarry.sources.tables import TABLES, load, register_views

__all__ = ["TABLES", "load", "register_views"]
