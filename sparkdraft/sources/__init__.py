from sparkdraft.sources import discover, dtypes, layout, schema, store, text

__all__ = ["discover", "dtypes", "layout", "schema", "store", "text"]
