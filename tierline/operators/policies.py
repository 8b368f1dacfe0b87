"""Row filters and column masks as SQL functions, and views that apply them to whoever asks.

The functions are temporary SQL functions with ``RETURN`` bodies over two tables of the session: ``policy_scope``
(analyst, country), which countries an analyst sees, and ``policy_groups`` (member, group_name). They ask for the
session's user themselves, so a view shows each user their own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The group that sees all rows, and the one that sees customers by name.
ADMINS, UNMASKED = "admins", "pii_readers"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def install(spark: SparkSession, scope: DataFrame, groups: DataFrame, user: str | None = None) -> None:
    """Make the policy functions of the session. Without ``user`` they ask for the session's own.

    - ``policy_user()``: who asks
    - ``in_group(name)``: whether they are a member
    - ``sees_country(country)``: whether a row is theirs to see; a NULL country is seen by admins only
    - ``masked_id(id)``: the id for members of the group that may see it, its SHA-256 in hex for others
    """
    scope.select("analyst", "country").createOrReplaceTempView("policy_scope")
    groups.select("member", "group_name").createOrReplaceTempView("policy_groups")
    # Spark takes no SQL function inside a subquery, so the bodies name the user themselves.
    who = "current_user()" if user is None else _text(user)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION policy_user() RETURNS STRING RETURN {who}")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION in_group(wanted STRING) RETURNS BOOLEAN RETURN "
        f"coalesce(array_contains((SELECT collect_set(g.group_name) FROM policy_groups g WHERE g.member = {who}), wanted), false)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION sees_country(place STRING) RETURNS BOOLEAN RETURN "
        f"in_group('{ADMINS}') OR coalesce(array_contains("
        f"(SELECT collect_set(s.country) FROM policy_scope s WHERE s.analyst = {who}), place), false)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION masked_id(id STRING) RETURNS STRING RETURN "
        f"CASE WHEN in_group('{UNMASKED}') THEN id ELSE sha2(id, 256) END"
    )


def secured_view(spark: SparkSession, name: str, source: DataFrame, mask: str | None = None, country: str = "country") -> None:
    """A view ``name`` of ``source`` under the policies: rows by ``country``, and ``mask`` hashed for most users.

    What a user may see is looked up once for a query, as scalar subqueries; the countries of one analyst are few,
    and no row of the source is shuffled for them.
    """
    source.createOrReplaceTempView(f"{name}_unsecured")
    columns = ", ".join(f"masked_id(`{c}`) AS `{c}`" if c == mask else f"`{c}`" for c in source.columns)
    where = f"WHERE sees_country(`{country}`)" if country in source.columns else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {columns} FROM {name}_unsecured {where}")
