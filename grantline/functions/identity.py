"""Identities in URNs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the prefix of a user URN.
USER_PREFIX = "urn:li:corpuser:"


def non_empty(text: Column) -> Column:
    """Null for the empty string, at the point of use only."""
    return F.when(text != "", text)


def user_id(urn: Column) -> Column:
    """Identity part of a user URN; null for any other URN and for an empty identity."""
    return F.when(
        F.startswith(urn, F.lit(USER_PREFIX)),
        non_empty(F.substr(urn, F.lit(len(USER_PREFIX) + 1))),
    )


def username(urn: Column, username_format: str = "urn_id") -> Column:
    """Warehouse user name of a requestor."""
    identity = user_id(urn)
    if username_format == "email_local_part":
        return non_empty(F.substring_index(identity, "@", 1))
    return identity


def email_from_urn(urn: Column) -> Column:
    """The identity itself if it looks like a mail address."""
    identity = user_id(urn)
    return F.when(F.contains(identity, F.lit("@")), identity)


def resolved_email(form_email: Column, requestor_urn: Column) -> Column:
    """Form value if there is one, else the address in the requestor's URN."""
    return F.coalesce(non_empty(form_email), email_from_urn(requestor_urn))


def plain_identifier(name: Column) -> Column:
    """True for a name that needs no quoting in the target's SQL, null for null."""
    return name.rlike(r"^[A-Za-z_][A-Za-z0-9_$]*$")
