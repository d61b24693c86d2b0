from tidemark.sources.files import read_incremental, read_table
from tidemark.sources.jdbc import Connection, Partitioning, jdbc_options, read_jdbc, secret

__all__ = ["Connection", "Partitioning", "jdbc_options", "read_incremental", "read_jdbc", "read_table", "secret"]
