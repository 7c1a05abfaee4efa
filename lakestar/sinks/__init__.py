from lakestar.sinks.once import append_once
from lakestar.sinks.tables import persisted, write_table

__all__ = ["append_once", "persisted", "write_table"]
