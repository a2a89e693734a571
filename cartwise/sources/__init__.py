from .catalog import load_sources, path_join, read_source
from .delimited import read_delimited, read_delimited_checked

__all__ = ["load_sources", "path_join", "read_source", "read_delimited", "read_delimited_checked"]
