"""Reading, restricting and publishing tables."""

from reelhouse.sources.catalog import Catalog, ColumnGrant, RestrictedTables, RowPolicy
from reelhouse.sources.publish import create_table_as, drop_table, publish, truncate_table
from reelhouse.sources.session import checkpointed, local_session

__all__ = [
    "Catalog",
    "ColumnGrant",
    "RestrictedTables",
    "RowPolicy",
    "checkpointed",
    "create_table_as",
    "drop_table",
    "local_session",
    "publish",
    "truncate_table",
]
