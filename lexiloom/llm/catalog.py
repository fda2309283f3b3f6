"""What the driver registers: queries and the SQL of those that SQL can express."""

from lexiloom.llm.oracles import SQL
from lexiloom.llm.queries import QUERIES

__all__ = ["QUERIES", "SQL"]
