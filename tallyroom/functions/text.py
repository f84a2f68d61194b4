"""String expressions; all are JVM-side columns."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Provider domain -> spellings that mean it.  A domain listed
# under itself is rewritten too, which only matters where dots are dropped.
DOMAIN_ALIASES: Mapping[str, Sequence[str]] = {
    "gmail.com": ("gmail.com", "googlemail.com", "gmial.com", "gmai.com", "gamil.com"),
    "yahoo.com": ("yaho.com", "yahooo.com", "yaho.co"),
    "hotmail.com": ("hotmial.com", "hotmal.com"),
    "outlook.com": ("outlok.com", "outlookk.com"),
}

# Providers that ignore dots in the local part.
DOT_BLIND_DOMAINS: Sequence[str] = ("gmail.com",)


def clean_label(text: Column) -> Column:
    """Lower-case without surrounding spaces (tabs stay, as SQL trim leaves them)."""
    return F.lower(F.trim(text))


def blank_to_null(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.nullif(trimmed, F.lit(""))


def canonical_email(
    email: Column,
    aliases: Mapping[str, Sequence[str]] = DOMAIN_ALIASES,
    dot_blind: Collection[str] = DOT_BLIND_DOMAINS,
) -> Column:
    """The address under which spelling variants of one account coincide.

    Expects an already lower-cased, trimmed address.  Addresses of unlisted
    domains come back unchanged.
    """
    local = F.split_part(email, F.lit("@"), F.lit(1))
    domain = F.split_part(email, F.lit("@"), F.lit(2))
    provider_of = F.create_map(
        *[F.lit(text) for provider, spellings in aliases.items() for spelling in spellings for text in (spelling, provider)]
    )
    provider = F.try_element_at(provider_of, domain)
    mailbox = F.when(provider.isin(*dot_blind), F.replace(local, F.lit("."), F.lit(""))).otherwise(local)
    return F.when(provider.isNull(), email).otherwise(F.concat(mailbox, F.lit("@"), provider))
