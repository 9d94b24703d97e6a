"""Role resolution: form value first, else the requestor's default role."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.functions import identity
from grantline.operators.skew import lookup_join
from grantline.settings import Settings

# Fixed value: the property that names a user's default role.
DEFAULT_ROLE = "DEFAULT_ROLE"
_BLANKS = " \t\n\r\x0b\x0c"


def default_roles(user_properties: DataFrame) -> DataFrame:
    """``(key, default_role)``, one row per user.

    Of several non-empty values the first counts, by ``ordinal`` where the rows have
    one; a value of blanks only gives no role.
    """
    order = (
        F.struct("ordinal", "value") if "ordinal" in user_properties.columns else F.col("value")
    )
    named = user_properties.filter(
        (F.col("property") == DEFAULT_ROLE) & (F.col("value") != "")
    )
    first = named.groupBy(F.col("username").alias("key")).agg(
        F.min_by("value", order).alias("value")
    )
    trimmed = identity.non_empty(F.btrim("value", F.lit(_BLANKS)))
    return first.select("key", trimmed.alias("default_role")).filter(
        F.col("default_role").isNotNull()
    )


def lookup_user(settings: Settings) -> Column:
    """User name to look up, null where the form names a role."""
    form_role = identity.non_empty(F.col("snowflake_role"))
    return F.when(
        form_role.isNull(),
        identity.username(F.col("requestor_urn"), settings.username_format),
    )


def resolve_roles(
    requests: DataFrame,
    roles: DataFrame,
    settings: Settings,
    needed: Column | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Adds ``default_role``, ``resolved_role``, ``role_origin`` and ``resolved_email``.

    ``needed`` leaves rows out of the look-up; ``counted`` is a frame with the same
    request columns on which to find requestors with very many requests.
    """
    user = lookup_user(settings)
    key = user if needed is None else F.when(needed, user)
    form_role = identity.non_empty(F.col("snowflake_role"))
    found = lookup_join(
        requests,
        roles,
        key,
        "default_role",
        F.col("urn"),
        settings.hot_key_rows,
        None if counted is None else counted.select(user.alias("key")),
    )
    return found.withColumns(
        {
            "resolved_role": F.coalesce(form_role, F.col("default_role")),
            "role_origin": F.when(form_role.isNotNull(), F.lit("form")).when(
                F.col("default_role").isNotNull(), F.lit("default_role")
            ),
            "resolved_email": identity.resolved_email(
                F.col("requestor_email"), F.col("requestor_urn")
            ),
        }
    )
