"""Where rows come from and go to: the CSV landing area, its inventory, month-foldered tables and snapshots."""

from .inventory import Inventory
from .landing import Landing
from .snapshots import SnapshotTable
from .tables import MonthTable

__all__ = ["Inventory", "Landing", "MonthTable", "SnapshotTable"]
