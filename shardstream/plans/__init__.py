"""The registered queries, with the SQL each one has to agree with."""

from shardstream.plans.oracles import ORACLES
from shardstream.plans.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
