from lakestar.functions.keys import content_hash, content_text
from lakestar.functions.parsing import cast_key, parse_date, parse_timestamp, wall_clock_instant

__all__ = ["cast_key", "content_hash", "content_text", "parse_date", "parse_timestamp", "wall_clock_instant"]
