from sluiceworks.plans.oracle import ORACLE
from sluiceworks.plans.queries import QUERIES

__all__ = ["ORACLE", "QUERIES"]
