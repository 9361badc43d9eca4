from harborlens.sources.tables import TABLES, Tables, table

__all__ = ["TABLES", "Tables", "table"]
