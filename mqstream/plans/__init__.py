"""Named queries over the test tables, with the SQL each one answers."""

from . import relational_queries, replay_queries, stream_queries, table_queries  # noqa: F401
from .catalog import QUERIES, SQL  # noqa: F401
