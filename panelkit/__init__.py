"""Entity-by-date panel analytics as lazy Spark DataFrame operators."""

from .binding import Panel

__all__ = ["Panel"]
