from roostline.sources.raw import RawSources, SCHEMAS, read_sources, read_table

__all__ = ["SCHEMAS", "RawSources", "read_sources", "read_table"]
