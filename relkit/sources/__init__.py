from relkit.sources.tables import TABLES, Tables, dataset_token

__all__ = ["TABLES", "Tables", "dataset_token"]
