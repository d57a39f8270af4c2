"""Linking addresses of one person, the management tree, and scoping of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions.columns import is_corporate
from loamline.sources.shared import written

col = F.col


def derived_alias(events: DataFrame, metrics: DataFrame, *, least_sessions: int = 2) -> DataFrame:
    """Personal addresses that share at least two sessions with exactly one corporate address.

    Pairs are distinct per session before they meet, so a busy session does not multiply rows.
    """
    both = events.select("session_id", "user_email").union(metrics.select("session_id", "user_email"))
    seen = both.where(col("session_id").isNotNull() & col("user_email").isNotNull()).distinct()
    personal = seen.where(~is_corporate(col("user_email"))).withColumnRenamed("user_email", "personal_email")
    corporate = seen.where(is_corporate(col("user_email"))).withColumnRenamed("user_email", "corporate_email")
    pairs = personal.join(corporate, "session_id").groupBy("personal_email", "corporate_email").agg(F.count("*").alias("shared_sessions"))
    partners = F.count("*").over(Window.partitionBy("personal_email"))
    return pairs.withColumn("_n", partners).where((col("_n") == 1) & (col("shared_sessions") >= least_sessions)).drop("_n")


def scoping_address(users: DataFrame, manual: DataFrame, derived: DataFrame) -> DataFrame:
    """user_email and the address it is scoped by; a manual row outranks and may suppress."""
    m = manual.select(col("personal_email").alias("user_email"), col("corporate_email").alias("_m"), F.lit(True).alias("_is"))
    d = derived.select(col("personal_email").alias("user_email"), col("corporate_email").alias("_d"))
    to = F.when(col("_is"), F.coalesce("_m", "user_email")).otherwise(F.coalesce("_d", "user_email"))
    return users.select("user_email").distinct().join(m, "user_email", "left").join(d, "user_email", "left").select("user_email", to.alias("scope_email"), (to != col("user_email")).alias("is_linked"))


def one_per_email(people: DataFrame) -> DataFrame:
    """The first row of each address in the order of all columns."""
    order = [col(c).asc_nulls_last() for c in people.columns]
    return people.withColumn("_n", F.row_number().over(Window.partitionBy("email").orderBy(*order))).where("_n = 1").drop("_n")


def _managers(people: DataFrame, excluded: tuple[str, ...]) -> DataFrame:
    """(email, parent): NULL where the manager is unknown, excluded or the person."""
    known = people.select(col("email").alias("_known")).distinct()
    real = col("_known").isNotNull() & (col("manager_email") != col("email"))
    if excluded:
        real &= ~col("manager_email").isin(*excluded)
    links = people.select("email", "manager_email").join(known, col("manager_email") == col("_known"), "left")
    return links.select("email", F.when(real, col("manager_email")).alias("parent"))


def management_tree(people: DataFrame, *, excluded: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(email, path from the root) of everyone below a root, and (email, parent) of those on or below a cycle.

    Unknown and excluded managers make roots. Each round joins everyone's path with that of the head it has come to, so
    paths double and the rounds grow with the logarithm of the depth. Once a round reaches no further root, none will:
    whoever then still has a head is on or below a cycle and has no path.
    """
    links = written(_managers(people, excluded), "managers")
    state = written(links.select("email", col("parent").alias("head"), F.array("email").alias("path")), "paths")
    left = state.where(col("head").isNotNull()).count()
    while left:
        up = state.select(col("email").alias("_at"), col("head").alias("_next"), col("path").alias("_above"))
        far = state.where(col("head").isNotNull()).join(up, col("head") == col("_at"))
        step = far.select("email", col("_next").alias("head"), F.concat("_above", "path").alias("path"))
        state = written(step.unionByName(state.where(col("head").isNull())), "paths")
        before, left = left, state.where(col("head").isNotNull()).count()
        if left == before:
            break
    return state.where(col("head").isNull()).select("email", "path"), links.join(state.where(col("head").isNotNull()), "email", "left_semi")


def management_paths(people: DataFrame, *, excluded: tuple[str, ...] = ()) -> DataFrame:
    """(email, path from the root) of everyone below a root."""
    return management_tree(people, excluded=excluded)[0]


def cyclic_managers(people: DataFrame, *, excluded: tuple[str, ...] = ()) -> DataFrame:
    """(email, parent) of those who come to no root, since a cycle of managers lies between."""
    return management_tree(people, excluded=excluded)[1]


def visible_to(rows: DataFrame, paths: DataFrame, viewer: str, *, email: str = "user_email") -> DataFrame:
    """Rows of the viewer and of everyone below."""
    below = paths.where(F.array_contains("path", viewer) | (col("email") == viewer)).select(col("email").alias(email))
    return rows.join(below, email, "left_semi")
