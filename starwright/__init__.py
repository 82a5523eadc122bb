"""Spark-native ETL and star-schema library.

Everything is DataFrame/SQL composition: Catalyst plans it, AQE re-plans it at
run time, and no code path pulls rows through the driver.
"""

from starwright.session import SETTINGS, prepare

__all__ = ["SETTINGS", "prepare"]
