"""Row-level security on the state dimension (P-13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three role kinds of the report security model.
ROLE_STATE, ROLE_REGION, ROLE_ALL = "STATE", "REGION", "ALL"


def allowed_states(d_state: DataFrame, grants: DataFrame, user) -> DataFrame:
    """State keys a user may see.

    ``grants``: ``(user_name, role, member)``; role STATE grants one state
    code, REGION a country/region name, ALL everything. The rule set is
    turned into the set of visible states (a small frame) by equi-joins, one
    per role kind.
    """
    u = user if isinstance(user, Column) else F.lit(user)
    g = grants.filter(F.col("user_name") == u)
    by_state = d_state.join(g.filter(F.col("role") == ROLE_STATE).select(F.col("member").alias("state_code")),
                            "state_code", "left_semi")
    by_region = d_state.join(g.filter(F.col("role") == ROLE_REGION).select(F.col("member").alias("country_name")),
                             "country_name", "left_semi")
    parts = [by_state.select("state_key"), by_region.select("state_key")]
    # the ALL role is a yes/no for the user: a scalar subquery, not a join
    has_all = g.filter(F.col("role") == ROLE_ALL).agg(F.count(F.lit(1)) > 0).scalar()
    parts.append(d_state.filter(has_all).select("state_key"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def apply_rls(fact: DataFrame, d_state: DataFrame, grants: DataFrame, user, fk: str = "state_key") -> DataFrame:
    """Fact rows in states the user may see: a broadcast semi join on the
    state key (the visible set is at most the state list)."""
    keys = allowed_states(d_state, grants, user)
    return fact.join(F.broadcast(keys), fact[fk] == keys["state_key"], "left_semi")
